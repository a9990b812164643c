"""The same figures from streams, run over all files of the source and then stopped."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake.operators import metrics, trend
from moodlake.operators.ingest import messages
from moodlake.operators.posts import clean_posts, decode_posts, stored_shape
from moodlake.operators.scoring import keyword_scorer, score, score_distinct
from moodlake.plans.metric_queries import (
    FEED_SQL, KPI_SQL, SENTIMENT_ROW_SQL, SOURCE_ROW_SQL, THROUGHPUT_SQL, TREND_SQL, _shown, shown_feed, start_text,
)
from moodlake.plans.posts_view import (
    POSTS_SQL, broker_stream, clean_sql, labelled_from, posts, posts_from_events, stream_table, table,
)
from moodlake.plans.registry import query
from moodlake.plans.scoring_queries import _keyword_scorer_sql
from moodlake.session import scratch_dir
from moodlake.sources.store import read_enriched, write_enriched
from moodlake.streaming import enrich, live


def _watermark(spark, sf_dir):
    """Files arrive in no order of time, so the watermark covers the time the table covers and no row counts as late."""
    times = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    return f"{(times.last - times.first).days + 1 if times.last else 1} days"


_STORED_SQL = _keyword_scorer_sql(
    f"""WITH {POSTS_SQL}, c AS (SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, tweet_text AS original_text,
      {clean_sql('tweet_text')} AS cleaned_text FROM posts)""",
    "id, ts, original_text, cleaned_text",
)


def _stored(rows):
    return rows.select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "original_text", "cleaned_text",
        "sentiment_label", F.round(F.col("confidence_score").cast("double"), 4).alias("confidence"), "inference_error",
    )


@query("stream_enrich", _STORED_SQL)
def stream_enrich(spark, sf_dir):
    folder = scratch_dir(spark, "stream")
    enriched = enrich.enrich(broker_stream(spark, sf_dir), lambda df: score(df, keyword_scorer))
    enrich.run(enrich.write_stream(enriched, f"{folder}/store", f"{folder}/checkpoint", trigger=None, name=None))
    return _stored(read_enriched(spark, f"{folder}/store"))


@query("stream_enrich_distinct", _STORED_SQL)
def _(spark, sf_dir):
    folder = scratch_dir(spark, "stream")

    def to_enriched(batch):
        return stored_shape(score_distinct(clean_posts(decode_posts(batch)), keyword_scorer))

    enrich.run(enrich.write_stream_batches(
        broker_stream(spark, sf_dir), to_enriched, f"{folder}/store", f"{folder}/checkpoint", trigger=None, name=None
    ))
    return _stored(read_enriched(spark, f"{folder}/store"))


@query("stream_then_backfill", _STORED_SQL)
def _(spark, sf_dir):
    """One store for all writers: a stream, its restart, a stream with a new checkpoint, a batch job.

    Each takes a quarter of the posts, dealt out by a hash of the message.
    """
    folder = scratch_dir(spark, "stream")

    def to_enriched(rows):
        return enrich.enrich(rows, lambda df: score(df, keyword_scorer))

    quarter = F.pmod(F.xxhash64("value"), F.lit(4))
    landed = messages(posts(spark, sf_dir)).select("value", quarter.alias("quarter"))
    # Two files arrive one after the other under one checkpoint, the third under another.
    for k, checkpoint in ((0, "first"), (1, "first"), (2, "second")):
        landed.filter(F.col("quarter") == k).select("value").write.mode("append").parquet(f"{folder}/topic-{checkpoint}")
        source = spark.readStream.schema("value string").parquet(f"{folder}/topic-{checkpoint}")
        enrich.run(enrich.write_stream(to_enriched(source), f"{folder}/store", f"{folder}/{checkpoint}", trigger=None))
    write_enriched(to_enriched(landed.filter("quarter = 3").select("value")), f"{folder}/store")
    return _stored(read_enriched(spark, f"{folder}/store"))


def _labelled_stream(spark, sf_dir):
    return labelled_from(posts_from_events(stream_table(spark, sf_dir, "events")))


def _run(spark, aggregate, keys, mode="update"):
    folder = scratch_dir(spark, "live")
    enrich.run(live.write_updates(aggregate, f"{folder}/rows", f"{folder}/checkpoint", mode, trigger=None, keys=keys))
    return live.read_latest(spark, f"{folder}/rows", keys)


@query("stream_trend", TREND_SQL)
def _(spark, sf_dir):
    points = trend.sentiment_trend(_labelled_stream(spark, sf_dir), watermark=_watermark(spark, sf_dir))
    return _shown(_run(spark, points, ["window_start"]))


@query("stream_throughput", THROUGHPUT_SQL)
def _(spark, sf_dir):
    counts = metrics.throughput(_labelled_stream(spark, sf_dir), watermark=_watermark(spark, sf_dir))
    return _run(spark, counts, ["window_start"]).select(start_text(), "n", "posts_per_second")


@query("stream_sentiment_mix", SENTIMENT_ROW_SQL)
def _(spark, sf_dir):
    return _run(spark, metrics.mix_row(_labelled_stream(spark, sf_dir)), [], mode="complete")


@query("stream_source_mix", SOURCE_ROW_SQL)
def _(spark, sf_dir):
    row = metrics.mix_row(_labelled_stream(spark, sf_dir), "source", metrics.SOURCES)
    return _run(spark, row, [], mode="complete")


@query("stream_kpis", KPI_SQL)
def _(spark, sf_dir):
    return _run(spark, metrics.kpi_summary(_labelled_stream(spark, sf_dir)), [], mode="complete")


@query("stream_recent_feed", FEED_SQL)
def _(spark, sf_dir):
    folder = scratch_dir(spark, "live")
    posts = _labelled_stream(spark, sf_dir)
    enrich.run(live.write_feed(posts, f"{folder}/rows", f"{folder}/checkpoint", trigger=None))
    return shown_feed(live.read_feed(spark, f"{folder}/rows"))
