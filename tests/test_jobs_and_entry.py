import json
import os

import duckdb
import pytest

import __spark_entry__ as contract
from moodlake.jobs import enrich, ingest, report, train

SMALLEST = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def test_csv_to_report(spark, folder, capsys):
    """All four programs in a row, as a user runs them."""
    os.makedirs(folder + "/csv")
    texts = ["I love this", "terrible thing", "it arrived", " "]
    with open(folder + "/csv/posts.csv", "w") as f:
        f.write("id,timestamp,tweet_text\n")
        f.writelines(f"{i},2024-01-{i % 28 + 1:02d} 10:00:00,{texts[i % 4]}\n" for i in range(200))
    counts = ingest.main([folder + "/csv", "--out", folder + "/messages", "--rejects", folder + "/rejects"])
    assert {r.reject_reason: r["count"] for r in spark.read.json(folder + "/rejects").groupBy("reject_reason").count().collect()} == {
        "empty_text": 50
    }
    assert counts == {"read": 200, "accepted": 150, "rejected": 50}
    enrich.main(["--messages", folder + "/messages", "--store", folder + "/store", "--checkpoint", folder + "/ck", "--once"])
    assert spark.read.parquet(folder + "/store").count() == 150
    enrich.main([
        "--messages", folder + "/messages", "--store", folder + "/other", "--checkpoint", folder + "/ck2", "--once", "--distinct",
        "--scorer", "moodlake.operators.scoring:keyword_scorer", "--tasks", "3",
    ])
    assert spark.read.parquet(folder + "/other").count() == 150
    figures = train.main([
        folder + "/store", "--model", folder + "/model", "--features", "128", "--max-iter", "10", "--cache",
    ])
    assert figures["accuracy"] == 1.0
    enrich.main(["--messages", folder + "/messages", "--store", folder + "/again", "--model", folder + "/model", "--batch"])
    assert spark.read.parquet(folder + "/again").filter("sentiment_label = 'Negative'").count() == 50
    capsys.readouterr()
    report.main([folder + "/store", "--term", "love", "--hours", "48", "--view", "Week"])
    out = capsys.readouterr().out
    assert "posts_per_second" in out and "negative_pct" in out and "inference_error" in out


@pytest.mark.parametrize("flags", [["--distinct"], ["--tasks", "3"], ["--attempts", "1"], ["--model", "m", "--scorer", "a:b"]])
def test_flags_without_effect_are_refused(flags, capsys):
    with pytest.raises(SystemExit):
        enrich.main(["--messages", "m", "--store", "s", "--batch", *flags])


def test_train_exit_codes(spark, folder):
    with pytest.raises(SystemExit) as missing:
        train.main([folder + "/none", "--model", folder + "/m"])
    spark.createDataFrame([], "id string, sentiment_label string").write.parquet(folder + "/empty")
    with pytest.raises(SystemExit) as empty:
        train.main([folder + "/empty", "--model", folder + "/m"])
    assert (missing.value.code, empty.value.code) == (1, 2)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["sentiment_label", "n", "share_pct"]
    assert sum(r.share_pct for r in df.collect()) == pytest.approx(100, abs=1e-5)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALLEST}/{name}.parquet')")
    return connection


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(json.dumps([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALLEST)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(result.fetchall(), names)
