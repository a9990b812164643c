import json
import os
import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from moodlake import schemas
from moodlake.jobs import fold as fold_job
from moodlake.operators import metrics, sums, trend
from moodlake.sources import commits, store
from moodlake.sources.store import fold, read_enriched, read_sums, vacuum, write_enriched
from moodlake.streaming import enrich


@pytest.fixture
def part(spark):
    """part(first, n) -> posts with ids first..first + n - 1, in the stored shape; every seventh has no time."""

    def make(first, n):
        i = F.col("id")
        return spark.range(first, first + n).select(
            i.cast("string").alias("id"),
            F.when(i % 7 != 0, F.timestamp_seconds(F.lit(1_700_000_000) + i * 977)).alias("timestamp"),
            F.concat(F.lit("text "), i).alias("original_text"), F.concat(F.lit("text "), i).alias("cleaned_text"),
            F.element_at(F.array(*map(F.lit, ("Negative", "Neutral", "Positive"))), (i % 3 + 1).cast("int")).alias("sentiment_label"),
            F.when(i % 11 != 0, ((i % 50) / 50).cast("float")).alias("confidence_score"),
            F.when(i % 5 == 0, "api_unavailable").alias("inference_error"),
        )

    return make


def ids(df):
    return sorted(int(r.id) for r in df.select("id").collect())


def writes(path):
    return sorted(d for d in os.listdir(path) if d.startswith("write="))


def test_crashed_write_is_never_seen(spark, folder, part, monkeypatch):
    path = folder + "/s"
    write_enriched(part(0, 10), path)

    def crash(*args, **kwargs):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(commits, "commit", crash)
        with pytest.raises(RuntimeError):
            write_enriched(part(10, 10), path)
    assert len(writes(path)) == 2 and ids(read_enriched(spark, path)) == list(range(10))
    write_enriched(part(10, 10), path)
    assert ids(read_enriched(spark, path)) == list(range(20))
    assert len(vacuum(spark, path, 0)) == 1 and ids(read_enriched(spark, path)) == list(range(20))


def test_crashed_fold_changes_nothing(spark, folder, part, monkeypatch):
    path = folder + "/s"
    for k in range(3):
        write_enriched(part(10 * k, 10), path)

    def crash(*args, **kwargs):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(commits, "commit", crash)
        with pytest.raises(RuntimeError):
            fold(spark, path)
    assert len(writes(path)) == 4 and ids(read_enriched(spark, path)) == list(range(30))
    fold(spark, path)
    assert ids(read_enriched(spark, path)) == list(range(30)) and len(commits.read_state(spark, path).live) == 1


def test_reader_keeps_its_version_during_a_fold(spark, folder, part):
    path = folder + "/s"
    for k in range(3):
        write_enriched(part(10 * k, 10), path)
    before = read_enriched(spark, path)
    assert fold(spark, path) == 3
    write_enriched(part(30, 5), path)
    assert ids(before) == list(range(30))
    assert ids(read_enriched(spark, path)) == list(range(35))
    assert ids(read_enriched(spark, path, version=1)) == list(range(20))
    with pytest.raises(ValueError, match="no version"):
        read_enriched(spark, path, version=99)
    assert len(vacuum(spark, path, 0)) == 3 and vacuum(spark, path, 0) == []
    assert ids(read_enriched(spark, path)) == list(range(35))
    fresh = [d for d in os.listdir(path + "/_sums")]
    assert sorted(fresh) == writes(path)


def test_two_folds_at_once_lose_nothing(spark, folder, part, monkeypatch):
    path = folder + "/s"
    for k in range(2):
        write_enriched(part(10 * k, 10), path)
    real, seen = commits.commit, []

    def overtaken(*args, **kwargs):
        if not seen:
            seen.append(True)
            fold(spark, path)
        return real(*args, **kwargs)

    monkeypatch.setattr(commits, "commit", overtaken)
    with pytest.raises(commits.Conflict):
        fold(spark, path)
    assert ids(read_enriched(spark, path)) == list(range(20))


def test_writers_at_once_all_count(spark, folder):
    path = folder + "/s"
    os.makedirs(path)
    failed = []

    def add(k):
        try:
            for i in range(12):
                commits.commit(spark, path, {f"write={k}-{i}": 1})
        except Exception as exc:  # noqa: BLE001
            failed.append(exc)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    state = commits.read_state(spark, path)
    assert not failed and len(state.live) == 48 and state.version == 47
    # However long the log, a reader opens the files since the last full one.
    assert "state" in json.load(open(f"{path}/_commits/{32:012d}.json"))
    os.remove(f"{path}/_commits/{3:012d}.json")
    assert commits.read_state(spark, path).live == state.live


def test_a_name_is_taken_once(spark, folder):
    files = commits.Files(spark, folder)
    assert files.create("_commits/000000000000.json", "a") is True
    assert files.create("_commits/000000000000.json", "b") is False
    assert open(folder + "/_commits/000000000000.json").read() == "a"
    assert [n for n in os.listdir(folder + "/_commits") if not n.startswith(".")] == ["000000000000.json"]


def test_repeated_batch_is_stored_once(spark, folder, part):
    path = folder + "/s"
    assert store.store_batch(part(0, 5), path, "s-0", ("s", 0)) == 0
    assert store.store_batch(part(0, 5), path, "s-0", ("s", 0)) is None
    assert store.store_batch(part(5, 5), path, "s-1", ("s", 1)) == 1
    fold(spark, path)
    assert store.store_batch(part(5, 5), path, "s-1", ("s", 1)) is None
    assert store.store_batch(part(10, 0), path, "s-2", ("s", 2)) == 3
    assert ids(read_enriched(spark, path)) == list(range(10))


def test_stores_without_a_log_are_taken_in(spark, folder, part):
    path = folder + "/s"
    part(0, 5).write.partitionBy("sentiment_label").parquet(path + "/write=batch-1")
    part(5, 5).write.partitionBy("sentiment_label").parquet(path + "/write=batch-2")
    assert ids(read_enriched(spark, path)) == list(range(10))
    write_enriched(part(10, 5), path)
    assert ids(read_enriched(spark, path)) == list(range(15))
    assert read_sums(spark, path).agg(F.sum("n")).first()[0] == 15
    fold(spark, path)
    assert ids(read_enriched(spark, path)) == list(range(15)) and read_sums(spark, path).agg(F.sum("n")).first()[0] == 15
    other = folder + "/t"
    part(0, 5).write.partitionBy("sentiment_label").parquet(other + "/write=batch-1")
    part(5, 5).write.partitionBy("sentiment_label").parquet(other + "/write=batch-2")
    fold(spark, other)
    assert ids(read_enriched(spark, other)) == list(range(10)) and len(commits.read_state(spark, other).live) == 1
    assert fold(spark, folder + "/nothing") is None
    with pytest.raises(AnalysisException):
        read_enriched(spark, folder + "/nothing")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_reports_from_sums_equal_the_full_scan(spark, folder, part):
    path = folder + "/s"
    for k in (3, 0, 2, 1):
        write_enriched(part(100 * k, 100), path)
    for _ in range(2):
        posts, counted = read_enriched(spark, path), read_sums(spark, path)
        assert same(sums.kpi_summary(counted), metrics.kpi_summary(posts))
        assert same(sums.mix(counted), metrics.mix(posts))
        assert same(sums.failure_rate(counted), metrics.failure_rate(posts))
        for width in ("1 hour", "1 day"):
            timed = posts.filter("timestamp IS NOT NULL")
            assert same(sums.sentiment_trend(counted, width), trend.sentiment_trend(timed, width))
        # Only the small tables are read.
        files = counted.inputFiles()
        assert files and all("/_sums/" in f for f in files) and len({f.split("/_sums/")[1].split("/")[0] for f in files}) == len(commits.read_state(spark, path).live)
        fold(spark, path)
    empty = sums.kpi_summary(counted.filter("false")).first()
    assert (empty.total, empty.mean_confidence_pct, empty.positive_pct) == (0, None, 0.0)


def test_fold_job(spark, folder, part, capsys):
    path = folder + "/s"
    for k in range(3):
        write_enriched(part(10 * k, 10), path)
    fold_job.main([path, "--keep-hours", "0"])
    assert capsys.readouterr().out.splitlines() == ["folded in version 3", "3 folders removed"]
    fold_job.main([path])
    assert capsys.readouterr().out.splitlines() == ["nothing to fold", "0 folders removed"]
    assert len(writes(path)) == 1 and ids(read_enriched(spark, path)) == list(range(30))


def test_messages_without_an_id_are_all_kept(spark, folder):
    os.makedirs(folder + "/in")

    def put(name, *lines):
        with open(f"{folder}/in/{name}", "w") as f:
            f.write("".join(line + "\n" for line in lines))

    def run():
        source = spark.readStream.text(folder + "/in")
        enriched = enrich.without_replays(source)
        assert enrich.run(enriched.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/c").trigger(availableNow=True).start())
        return sorted(r.value for r in spark.read.parquet(folder + "/out").collect())

    put("a", '{"id":"1"}', '{"id":"1"}', "not json", "not json", '{"id":null}')
    assert run() == sorted(['{"id":"1"}', "not json", "not json", '{"id":null}'])
    # A restart knows the ids of before.
    put("b", '{"id":"1","more":0}', '{"id":"2"}')
    assert run() == sorted(['{"id":"1"}', "not json", "not json", '{"id":null}', '{"id":"2"}'])


def test_sums_of_rows_of_another_shape_are_left_out(spark, folder):
    path = folder + "/s"
    store.store_batch(spark.createDataFrame([("1", "x", "Neutral")], "id string, timestamp string, sentiment_label string"), path, "odd")
    assert commits.read_state(spark, path).live and not os.path.exists(path + "/_sums")
    assert schemas.STORED.fieldNames()[0] == "id"
