import json
import os

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from moodlake import schemas, session
from moodlake.operators import metrics, trend
from moodlake.operators.classifier import trainable
from moodlake.operators.posts import clean_posts, decode_posts, stored_shape
from moodlake.operators.scoring import RetryPolicy, keyword_scorer, score, score_distinct
from moodlake.sources import commits
from moodlake.sources.store import EmptyStore, read_enriched, write_enriched
from moodlake.streaming import enrich, live

TEXTS = ["I love it", "It is terrible", "It arrived", "", "best but broken", "@me #tag"]


def write_messages(folder, name, ids):
    with open(os.path.join(folder, name), "w") as f:
        for i in ids:
            post = {"id": str(i), "timestamp": f"2024-01-{i % 9 + 1:02d}T03:04:05+00:00", "tweet_text": TEXTS[i % len(TEXTS)]}
            f.write(json.dumps(post) + "\n")
        f.write("not json\n")


@pytest.fixture
def broker(folder):
    os.makedirs(folder + "/in")
    write_messages(folder + "/in", "a.txt", range(0, 40))
    write_messages(folder + "/in", "b.txt", range(40, 60))
    return folder


def scorer(df):
    return score(df, keyword_scorer)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def run_stream(spark, folder, **options):
    source = spark.readStream.option("maxFilesPerTrigger", 1).text(folder + "/in")
    query = enrich.write_stream(
        enrich.enrich(source, scorer), folder + "/store", folder + "/checkpoint", trigger=None, **options
    )
    assert enrich.run(query)
    return read_enriched(spark, folder + "/store")


def test_stream_equals_batch_and_resumes(spark, broker):
    stored = run_stream(spark, broker)
    batch = enrich.enrich(spark.read.text(broker + "/in"), scorer)
    assert stored.count() == 62 and rows(stored) == rows(batch)
    # Started again after more input: no row twice, none missing.
    write_messages(broker + "/in", "c.txt", range(60, 75))
    stored = run_stream(spark, broker)
    assert rows(stored) == rows(enrich.enrich(spark.read.text(broker + "/in"), scorer))
    assert rows(run_stream(spark, broker)) == rows(stored)


def test_batches_with_distinct_scoring(spark, broker):
    def to_enriched(batch):
        return stored_shape(score_distinct(clean_posts(decode_posts(batch)), keyword_scorer))

    for _ in range(2):  # the second run finds nothing new
        source = spark.readStream.option("maxFilesPerTrigger", 1).text(broker + "/in")
        assert enrich.run(enrich.write_stream_batches(
            source, to_enriched, broker + "/store", broker + "/checkpoint", trigger=None
        ))
    assert sorted(d.split("-")[2] for d in os.listdir(broker + "/store") if d.startswith("write=")) == ["0", "1"]
    stored = read_enriched(spark, broker + "/store")
    assert rows(stored) == rows(enrich.enrich(spark.read.text(broker + "/in"), scorer))


def test_failing_stream_raises(spark, broker):
    def fail(_batch):
        raise RuntimeError("boom")

    query = enrich.write_stream_batches(
        spark.readStream.text(broker + "/in"), fail, broker + "/store", broker + "/checkpoint", trigger=None
    )
    with pytest.raises(StreamingQueryException):
        enrich.run(query)


def test_timeout_stops_the_query(spark, broker):
    query = enrich.write_stream(
        enrich.enrich(spark.readStream.text(broker + "/in"), scorer), broker + "/store", broker + "/checkpoint",
        trigger="1 second",
    )
    assert enrich.run(query, timeout=6) is False
    assert not query.isActive


def labelled_stream(spark, folder):
    source = spark.readStream.option("maxFilesPerTrigger", 1).text(folder + "/in")
    return enrich.enrich(source, scorer).filter("timestamp is not null")


@pytest.mark.parametrize("operator, keys", [
    (lambda df, w: trend.sentiment_trend(df, watermark=w), ["window_start"]),
    (lambda df, w: metrics.throughput(df, "1 day", watermark=w), ["window_start"]),
    (lambda df, w: metrics.mix_row(df), []),
])
def test_live_figures_equal_batch(spark, broker, operator, keys):
    query = live.write_updates(
        operator(labelled_stream(spark, broker), "30 days"), broker + "/live", broker + "/live-checkpoint",
        mode="update" if keys else "complete", trigger=None,
    )
    assert enrich.run(query)
    batch = enrich.enrich(spark.read.text(broker + "/in"), scorer).filter("timestamp is not null")
    assert rows(live.read_latest(spark, broker + "/live", keys)) == rows(operator(batch, None))


def test_live_state_survives_a_restart(spark, broker):
    def run():
        points = trend.sentiment_trend(labelled_stream(spark, broker), watermark="30 days")
        assert enrich.run(live.write_updates(points, broker + "/live", broker + "/lc", trigger=None))
        return live.read_latest(spark, broker + "/live", ["window_start"])

    run()
    write_messages(broker + "/in", "c.txt", range(60, 90))
    batch = enrich.enrich(spark.read.text(broker + "/in"), scorer).filter("timestamp is not null")
    assert rows(run()) == rows(trend.sentiment_trend(batch))


def test_live_rows_are_put_together_and_read_back(spark, broker, monkeypatch):
    """However many batches there were, a reader opens a bounded number of folders, each of them whole."""
    monkeypatch.setattr(live, "MOST_FOLDERS", 2)
    for k in range(5):
        write_messages(broker + "/in", f"more{k}.txt", range(100 + 10 * k, 110 + 10 * k))
    points = trend.sentiment_trend(labelled_stream(spark, broker), watermark="30 days")
    assert enrich.run(live.write_updates(points, broker + "/live", broker + "/lc", trigger=None, keys=["window_start"]))
    batch = enrich.enrich(spark.read.text(broker + "/in"), scorer).filter("timestamp is not null")
    assert rows(live.read_latest(spark, broker + "/live", ["window_start"])) == rows(trend.sentiment_trend(batch))
    state = commits.read_state(spark, broker + "/live")
    assert len(state.live) <= 3 and list(state.batches.values()) >= [6]
    assert all("/write=" in f for f in live.read_latest(spark, broker + "/live", ["window_start"]).inputFiles())


def test_a_batch_stored_before_a_crash_is_not_stored_again(spark, broker):
    def put(batch_id, n):
        live._put(spark, broker + "/x", "run", batch_id, lambda older: (spark.range(n), older))

    put(0, 1)
    put(1, 2)
    put(1, 3)
    put(0, 4)
    assert live.read_feed(spark, broker + "/x").count() == 2
    with pytest.raises(FileNotFoundError):
        live.read_feed(spark, broker + "/none")


def test_rows_later_than_the_watermark_are_dropped(spark, folder):
    os.makedirs(folder + "/in")

    def put(name, *days):
        with open(f"{folder}/in/{name}", "w") as f:
            for day in days:
                f.write(json.dumps({"id": name, "timestamp": f"2024-01-{day:02d}T00:00:00+00:00", "tweet_text": "x"}) + "\n")

    def run():
        counts = metrics.throughput(labelled_stream(spark, folder), "1 day", watermark="2 days")
        assert enrich.run(live.write_updates(counts, folder + "/live", folder + "/c", trigger=None))
        return {r.window_start.day: r.n for r in live.read_latest(spark, folder + "/live", ["window_start"]).collect()}

    put("a", 1, 20)
    assert run() == {1: 1, 20: 1}
    put("b", 2, 19, 20)  # the 2nd is too late now, the 19th is not
    assert run() == {1: 1, 19: 1, 20: 2}


def test_live_feed_over_several_batches(spark, broker):
    query = live.write_feed(labelled_stream(spark, broker), broker + "/feed", broker + "/feed-checkpoint", trigger=None)
    assert enrich.run(query)
    state = commits.read_state(spark, broker + "/feed")
    assert list(state.batches.values()) == [1] and len(state.live) == 1
    batch = enrich.enrich(spark.read.text(broker + "/in"), scorer).filter("timestamp is not null")
    assert rows(live.read_feed(spark, broker + "/feed")) == rows(trend.recent_feed(batch))


def test_observed_counts_of_a_stream(spark, broker):
    from moodlake.operators.ingest import observe_counts, tag_rejects

    posts = decode_posts(spark.readStream.text(broker + "/in"))
    query = enrich.write_stream(
        observe_counts(tag_rejects(posts)).withColumn("sentiment_label", F.lit("Neutral")),
        broker + "/o", broker + "/oc", trigger=None, name="counted",
    )
    assert enrich.run(query)
    seen = [p.observedMetrics["ingest"] for p in query.recentProgress if "ingest" in p.observedMetrics]
    assert sum(m["read"] for m in seen) == 62 and sum(m["rejected"] for m in seen) == 12


def test_store_guards_and_pruning(spark, folder, broker):
    with pytest.raises(AnalysisException):
        read_enriched(spark, folder + "/nothing")
    spark.createDataFrame([], schemas.ENRICHED).write.parquet(folder + "/empty")
    with pytest.raises(EmptyStore):
        read_enriched(spark, folder + "/empty")

    enriched = enrich.enrich(spark.read.text(broker + "/in"), scorer)
    write_enriched(enriched, folder + "/compact", compact=True)
    assert rows(read_enriched(spark, folder + "/compact")) == rows(enriched)
    write_enriched(enriched, folder + "/backfill")
    stored = read_enriched(spark, folder + "/backfill", cache=True)
    assert rows(stored) == rows(enriched)
    stored.unpersist()
    positive = read_enriched(spark, folder + "/backfill").filter(
        "sentiment_label = 'Positive' and timestamp > timestamp'2024-01-05'"
    ).select("id")
    scan = positive._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sentiment_label" in scan
    assert "GreaterThan(timestamp" in scan
    assert "original_text" not in scan.split("ReadSchema")[1]


def test_unlabelled_rows_get_no_default_partition(spark, folder):
    df = spark.createDataFrame(
        [("1", None, "a", "a", None, 0.5), ("2", None, "b", "b", "", 0.5)],
        "id string, timestamp timestamp, original_text string, cleaned_text string, sentiment_label string,"
        " confidence_score float",
    )
    write_enriched(stored_shape(df), folder + "/s")
    (write,) = [d for d in os.listdir(folder + "/s") if d.startswith("write=")]
    assert [d for d in os.listdir(f"{folder}/s/{write}") if "=" in d] == ["sentiment_label=Neutral"]


def enriched_batch(spark, folder):
    return enrich.enrich(spark.read.text(folder + "/in"), scorer)


def test_backfill_into_a_streamed_store_is_read(spark, broker):
    streamed = run_stream(spark, broker)
    write_enriched(enriched_batch(spark, broker), broker + "/store")
    assert rows(read_enriched(spark, broker + "/store")) == sorted(2 * rows(enriched_batch(spark, broker)))
    assert streamed.count() == 62


@pytest.mark.parametrize("distinct", [False, True])
def test_new_checkpoint_and_backfill_lose_nothing(spark, broker, distinct):
    def stream(checkpoint, name):
        source = spark.readStream.text(f"{broker}/{name}")
        if distinct:
            def to_enriched(batch):
                return enrich.enrich(batch, lambda df: score_distinct(df, keyword_scorer))
            query = enrich.write_stream_batches(source, to_enriched, broker + "/store", broker + checkpoint, trigger=None)
        else:
            query = enrich.write_stream(enrich.enrich(source, scorer), broker + "/store", broker + checkpoint, trigger=None)
        assert enrich.run(query)

    stream("/c1", "in")
    os.makedirs(broker + "/later")
    write_messages(broker + "/later", "x.txt", range(60, 80))
    stream("/c2", "later")
    write_enriched(enriched_batch(spark, broker), broker + "/store")
    assert read_enriched(spark, broker + "/store").count() == 62 + 21 + 62


def test_old_layouts_are_read_along(spark, broker):
    old = enriched_batch(spark, broker).drop("inference_error")
    old.write.partitionBy("sentiment_label").parquet(broker + "/store")
    old.write.partitionBy("sentiment_label").parquet(broker + "/store/batch_id=0")
    write_enriched(enriched_batch(spark, broker), broker + "/store")
    assert read_enriched(spark, broker + "/store").count() == 3 * 62


def test_new_checkpoint_of_the_feed(spark, broker):
    def run(checkpoint):
        assert enrich.run(live.write_feed(labelled_stream(spark, broker), broker + "/feed", broker + checkpoint, trigger=None))
        return live.read_feed(spark, broker + "/feed")

    run("/f1")
    write_messages(broker + "/in", "c.txt", range(60, 90))
    batch = enriched_batch(spark, broker).filter("timestamp is not null")
    assert rows(run("/f2")) == rows(trend.recent_feed(batch))


def test_new_checkpoint_of_live_figures(spark, broker):
    def run(checkpoint):
        points = trend.sentiment_trend(labelled_stream(spark, broker), watermark="30 days")
        assert enrich.run(live.write_updates(points, broker + "/live", broker + checkpoint, trigger=None))
        return live.read_latest(spark, broker + "/live", ["window_start"])

    run("/l1")
    write_messages(broker + "/in", "c.txt", range(60, 90))
    batch = enriched_batch(spark, broker).filter("timestamp is not null")
    assert rows(run("/l2")) == rows(trend.sentiment_trend(batch))


def test_failed_calls_are_stored_and_never_learned_from(spark, broker):
    def failing():
        def run(texts):
            raise OSError("no service")
        return run

    quick = RetryPolicy(sleep=lambda seconds: None)
    failed = enrich.enrich(spark.read.text(broker + "/in"), lambda df: score(df, failing, retry=quick))
    write_enriched(failed, broker + "/failed")
    stored = read_enriched(spark, broker + "/failed")
    assert {r.inference_error for r in stored.collect()} == {"api_unavailable", "empty_text"}
    assert trainable(stored).count() == 0
    shares = {r.inference_error: r.n for r in metrics.failure_rate(stored).collect()}
    assert sum(shares.values()) == 62 and "none" not in shares


def test_scratch_tables_of_a_batch_go(spark, broker, monkeypatch):
    made, real = [], session.scratch_dir

    def noted(spark, name):
        made.append(real(spark, name))
        return made[-1]

    monkeypatch.setattr(session, "scratch_dir", noted)
    source = spark.readStream.text(broker + "/in")
    assert enrich.run(enrich.write_stream_batches(
        source, lambda b: enrich.enrich(b, lambda df: score_distinct(df, keyword_scorer)),
        broker + "/store", broker + "/ck", trigger=None,
    ))
    assert len(made) == 2 and not any(os.path.exists(p) for p in made)
    assert read_enriched(spark, broker + "/store").count() == 62


@pytest.mark.parametrize("name, root", [("stream_replayed", "replay"), ("stream_remembered", "remember"), ("stream_late_trend", "late")])
def test_a_wave_is_many_files_and_one_micro_batch(spark, folder, monkeypatch, name, root):
    """Micro-batches do not grow in number with the input's files, and no wave passes one task."""
    from moodlake.plans.registry import QUERIES
    from moodlake.streaming import enrich as streams

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(f"{folder}/events.parquet")
    seen, store = set(), streams.store_batch
    monkeypatch.setattr(streams, "store_batch", lambda rows, *rest: seen.add(rest[1]) or store(rows, *rest))
    monkeypatch.setattr("moodlake.plans.store_queries.scratch_dir", lambda spark, name: f"{folder}/{name}")
    got = QUERIES[name](spark, folder)
    plain = QUERIES["stream_enrich" if name != "stream_late_trend" else "stream_trend"](spark, folder)
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    assert 3 <= len(seen) <= 9  # three waves, and around each batches without data that only move the watermark
    assert spark.read.parquet(f"{folder}/{root}/topic").selectExpr("input_file_name() AS f").distinct().count() > 6
