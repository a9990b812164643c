import os
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import Observation, functions as F

from moodlake.operators.ingest import messages, normalise, observe_counts, reject_counts, tag_rejects, validate
from moodlake.operators.posts import clean_posts, decode_posts, stored_shape
from moodlake.sources import broker, csv_files
from moodlake.sources.csv_files import CSV_OPTIONS, inspect_blocks, inspect_files, read_csv, stream_csv

HEADER = b"id,timestamp,tweet_text\n"


def put(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data)
    return path


@pytest.fixture
def mixed_folder(folder):
    put(folder, "utf8.csv", HEADER + "1,2024-01-02 03:04:05,naïve\n".encode())
    put(folder, "bom.csv", b"\xef\xbb\xbf" + HEADER + "2,2024-01-02 03:04:05,bom é\n".encode())
    put(folder, "late [1] bad.csv", HEADER + b"3,x,plain\n4,x,caf\xe9\n")
    put(folder, "newline.csv", HEADER + b'5,x,"two\nlines, ""quoted"""\n')
    put(folder, "short.csv", HEADER + b"6,x\n7,x,   \n")
    put(folder, "order.csv", b"tweet_text,extra,timestamp,id\nswapped,e,x,8\n")
    put(folder, "lacking.csv", b"id,tweet_text\n9,no time\n")
    put(folder, "empty.csv", b"")
    put(folder, "header_only.csv", HEADER)
    return folder


def test_inspect(spark, mixed_folder):
    flags = {os.path.basename(r.file): r.is_utf8 for r in inspect_files(spark, mixed_folder).collect()}
    assert flags.pop("late%20%5B1%5D%20bad.csv") is False
    assert all(flags.values()) and "empty.csv" not in flags
    spanning = {os.path.basename(r.file) for r in inspect_files(spark, mixed_folder).collect() if r.multi_line}
    assert spanning == {"newline.csv"}
    plan = inspect_blocks(spark, mixed_folder)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "Sort" not in plan


def test_csv_files_of_all_kinds(spark, mixed_folder):
    rows = {r.id: r for r in read_csv(spark, mixed_folder).collect()}
    texts = {k: r.tweet_text for k, r in rows.items()}
    assert texts == {
        "1": "naïve", "2": "bom é", "3": "plain", "4": "café", "5": 'two\nlines, "quoted"',
        "6": None, "7": "   ", "8": "swapped", "9": "no time",
    }
    assert rows["8"].timestamp == "x" and rows["9"].missing_columns == "timestamp"


def test_validation_and_counts(spark, mixed_folder):
    raw = read_csv(spark, mixed_folder)
    valid, rejects = validate(raw)
    assert {r.id for r in valid.collect()} == {"1", "2", "3", "4", "5", "8"}
    assert {r.id: r.reject_reason for r in rejects.collect()} == {
        "6": "empty_text", "7": "empty_text", "9": "missing_column",
    }
    counts = {r.outcome: r.n for r in reject_counts(tag_rejects(raw)).collect()}
    assert counts == {"accepted": 6, "empty_text": 2, "missing_column": 1}
    seen = Observation("counts")
    observe_counts(tag_rejects(raw), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"read": 9, "accepted": 6, "rejected": 3}


def test_frame_without_required_column_is_rejected(spark):
    _valid, rejects = validate(spark.createDataFrame([("1", "t")], "id string, tweet_text string"))
    assert [r.reject_reason for r in rejects.collect()] == ["missing_column"]


def test_record_cap_counts_rejected_rows(spark, folder):
    put(folder, "a.csv", HEADER + b"1,x,a\n2,x,\n3,x,c\n4,x,d\n")
    capped = read_csv(spark, folder, max_records=3)
    assert capped.count() == 3
    assert validate(capped)[0].count() == 2
    assert read_csv(spark, folder, partitions=3).rdd.getNumPartitions() == 3


@contextmanager
def ranges_of(spark, size):
    """Files are read in byte ranges of this size."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_split_scan_without_newlines(spark, folder):
    put(folder, "a.csv", HEADER + b"".join(b"%d,x,text %d\n" % (i, i) for i in range(2000)))
    with ranges_of(spark, 4096):
        for rows in (read_csv(spark, folder), read_csv(spark, folder, multi_line=False)):
            assert rows.rdd.getNumPartitions() > 4
            assert rows.select("id").distinct().count() == 2000


def spanning_file(seed, n, newline="\n"):
    """Rows with newlines, quotes, commas, blank lines and nothing in fields, and a header line that comes again as data."""
    rng = random.Random(seed)
    parts = ["a", "\n", '""', ",", " ", "é", "\n\n", "long text " * 3, '""\n""', "id,timestamp,tweet_text"]
    rows = ["id,timestamp,tweet_text"]
    for i in range(n):
        body = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        rows.append(f'{i},"t\n{i}","{body}"' if rng.random() < 0.8 else f"{i},t,plain")
        if rng.random() < 0.1:
            rows.append("")
    return (newline.join(rows) + newline).encode()


@pytest.mark.parametrize("size", [64, 700, 5000, 1 << 20])
def test_one_file_with_newlines_in_fields_is_many_tasks(spark, folder, size):
    put(folder, "a.csv", spanning_file(size, 60 if size < 1000 else 400))
    put(folder, "b.csv", spanning_file(size + 1, 3))
    put(folder, "c.csv", HEADER + b'1,x,"' + b"one field larger than ranges\n" * 60 + b'"\n2,x,after\n')
    put(folder, "open.csv", HEADER + b'open,x,"never\nclosed\n')
    plain = spark.read.options(**CSV_OPTIONS, multiLine="true").csv(folder)
    want = sorted(map(tuple, plain.select("id", "timestamp", "tweet_text").collect()), key=str)
    with ranges_of(spark, size):
        rows = read_csv(spark, folder).select("id", "timestamp", "tweet_text")
        got = sorted(map(tuple, rows.collect()), key=str)
        tasks = rows.rdd.getNumPartitions()
    assert [r for r in got if r[0] != "open"] == [r for r in want if r[0] != "open"]
    assert [r[2].strip() for r in got if r[0] == "open"] == ["never\nclosed"]
    assert tasks > 3 if size < 5000 else tasks > 0


def test_ranges_too_many_to_send_are_shuffled(spark, folder, monkeypatch):
    put(folder, "a.csv", spanning_file(3, 300))
    put(folder, "b.csv", HEADER + b"x1,x,caf\xe9\n")
    want = sorted(map(tuple, read_csv(spark, folder).collect()), key=str)
    monkeypatch.setattr(csv_files, "MOST_SENT", 0)
    with ranges_of(spark, 500):
        assert sorted(map(tuple, read_csv(spark, folder).collect()), key=str) == want


def test_first_records_in_file_order(spark, folder):
    for k, name in enumerate(["a.csv", "b.csv", "c.csv"]):
        put(folder, name, HEADER + b"".join(b'%d,x,"two\nlines"\n' % (100 * k + i) for i in range(60)))
    order = [100 * k + i for k in range(3) for i in range(60)]
    with ranges_of(spark, 300):
        for n in (0, 61, 130, 999):
            rows = read_csv(spark, folder, max_records=n)
            assert sorted(int(r.id) for r in rows.collect()) == order[:n], n
        plan = read_csv(spark, folder, max_records=130)._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.splitlines() if "SinglePartition" in line or "GlobalLimit" in line] == []


def test_windows_line_ends(spark, folder):
    put(folder, "a.csv", spanning_file(5, 40, "\r\n"))
    rows = {r.id: r.tweet_text for r in read_csv(spark, folder).collect()}
    assert len(rows) == 40 and all(not (t or "").endswith("\r") for t in rows.values())


def test_headers_and_encodings_are_data(spark, folder):
    """Many layouts, one scan: the plan does not grow with them."""
    for i in range(12):
        names = ["id", "timestamp", "tweet_text", f"own{i % 3}"]
        names = names[i % 4:] + names[:i % 4]
        values = {"id": str(i), "timestamp": "t", "tweet_text": "café", f"own{i % 3}": f"o{i}"}
        text = ",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n"
        put(folder, f"{i:02}.csv", text.encode("latin-1" if i % 2 else "utf-8"))
    rows = read_csv(spark, folder)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    assert {r.id: (r.tweet_text, r[f"own{int(r.id) % 3}"]) for r in rows.collect()} == {str(i): ("café", f"o{i}") for i in range(12)}


def test_known_encoding_needs_one_scan(spark, folder):
    put(folder, "a.csv", HEADER + b'1,x,caf\xe9\n2,x,"a\nb"\n')
    put(folder, "b.csv", HEADER + b"3,x,c\n")
    rows = read_csv(spark, folder, encoding="ISO-8859-1")
    assert {r.id: r.tweet_text for r in rows.collect()} == {"1": "café", "2": "a\nb", "3": "c"}
    assert rows.first().missing_columns is None
    put(folder, "c.csv", b"tweet_text,id,timestamp\nx,4,x\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, folder, encoding="UTF-8").collect()


def test_all_files_empty(spark, folder):
    put(folder, "a.csv", b"")
    assert read_csv(spark, folder).count() == 0


def test_normalise_and_messages(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-02 03:04:05", " hi "), (2, "junk", "x")], "id int, timestamp string, tweet_text string"
    )
    rows = {r.id: r for r in normalise(raw).collect()}
    assert rows["1"].tweet_text == "hi" and not rows["1"].ts_defaulted
    assert rows["2"].timestamp is None and rows["2"].ts_defaulted
    fixed = F.lit("2000-01-01 00:00:00").cast("timestamp")
    filled = normalise(raw, fixed).filter("ts_defaulted").first()
    assert filled.timestamp is not None
    values = {r.value for r in messages(normalise(raw)).collect()}
    assert values == {
        '{"id":"1","timestamp":"2024-01-02T03:04:05+00:00","tweet_text":"hi"}', '{"id":"2","tweet_text":"x"}',
    }


def test_decode_edges(spark):
    values = ['{"id":"1","timestamp":"x","tweet_text":"hi"}', '{"id":5}', "not json", "null", "", None]
    df = spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "value binary")
    got = [tuple(r) for r in decode_posts(df).collect()]
    assert got == [("1", "x", "hi"), ("5", None, None)] + [(None, None, None)] * 4


def test_stored_shape(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-02T03:04:05Z", "a", "a", None, 0.5, None), ("2", "bad", "b", "b", "", 0.1, "e")],
        "id string, timestamp string, original_text string, cleaned_text string, sentiment_label string,"
        " confidence_score double, inference_error string",
    )
    rows = stored_shape(df).collect()
    assert [r.sentiment_label for r in rows] == ["Neutral", "Neutral"]
    assert rows[1].timestamp is None
    assert "inference_error" in stored_shape(df, keep_error=True).columns
    assert clean_posts(df.withColumnRenamed("original_text", "tweet_text")).columns == [
        "id", "timestamp", "original_text", "cleaned_text",
    ]


def test_csv_stream_checks_headers(spark, folder):
    put(folder, "a.csv", HEADER + b'1,x,"two\nlines"\n')
    out = folder + "-out"
    query = stream_csv(spark, folder, max_files=1).writeStream.format("parquet").trigger(availableNow=True)
    query.option("checkpointLocation", out + "/c").start(out + "/t").awaitTermination()
    assert spark.read.parquet(out + "/t").first().tweet_text == "two\nlines"


def test_broker_options():
    source = broker.source_options("host:1", min_partitions=64)
    assert source == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "social_sentiment", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "minPartitions": "64",
    }
    assert broker.source_options("host:1", max_offsets=500)["maxOffsetsPerTrigger"] == "500"
    sink = broker.sink_options("host:1")
    assert sink["kafka.acks"] == "all" and sink["kafka.max.in.flight.requests.per.connection"] == "1"
    assert sink["kafka.retries"] == "3" and sink["kafka.linger.ms"] == "10" and sink["kafka.batch.size"] == "32768"


def test_first_rows_are_not_sorted_in_one_task(spark, folder, monkeypatch):
    """The files a cap is tried on are written by range of ids, so that no task holds them all."""
    from moodlake.plans import ingest_queries
    from moodlake.plans.posts_view import posts
    from moodlake.plans.registry import QUERIES

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(ingest_queries, "scratch_dir", lambda spark, name: f"{folder}/{name}")
    partitions = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = QUERIES["csv_first_rows"](spark, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", partitions)
    assert spark.read.text(f"{folder}/csv/2").selectExpr("input_file_name() AS f").distinct().count() > 1
    wanted = posts(spark, folder).selectExpr("id", "concat(tweet_text, '\n', source) AS tweet_text").filter("cast(id AS bigint) < 700")
    assert got.count() == 700 and got.exceptAll(wanted).isEmpty()
