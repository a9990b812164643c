"""The store as a log of writes: folding, sums beside writes, late rows, repeated messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake import schemas
from moodlake.operators import sums
from moodlake.operators.ingest import messages
from moodlake.operators.scoring import keyword_scorer, score, score_distinct
from moodlake.plans.metric_queries import KPI_SQL, TREND_SQL, _shown
from moodlake.plans.posts_view import LABELLED_SQL, POSTS_SQL, clean_sql, labelled, labelled_from, spread_posts
from moodlake.plans.registry import query
from moodlake.plans.stream_queries import _STORED_SQL, _stored
from moodlake.session import scratch_dir, scratch_table
from moodlake.sources.answers import read_answers
from moodlake.sources.store import fold, read_enriched, read_sums, vacuum, write_enriched
from moodlake.streaming import enrich


def _filled(spark, sf_dir, parts):
    """A store with one write per part of the labelled posts, the parts being dealt out by day, newest days first."""
    path = scratch_dir(spark, "store")
    day = F.floor(F.unix_seconds("timestamp") / 86400)
    rows = labelled(spark, sf_dir)
    for k in range(parts):
        write_enriched(rows.filter(F.pmod(-day, F.lit(parts)) == k), path)
    return path


_KEPT_SQL = f"""WITH {LABELLED_SQL} SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, original_text, cleaned_text,
  sentiment_label, round(confidence_score, 4) AS confidence, inference_error FROM labelled"""


@query("store_fold", _KEPT_SQL)
def _(spark, sf_dir):
    """Writes folded while others go on, folded again with those, and all replaced folders removed."""
    path = _filled(spark, sf_dir, 4)
    fold(spark, path)
    write_enriched(read_enriched(spark, path).filter("false"), path)
    more = labelled(spark, sf_dir).withColumn("id", F.concat(F.lit("again-"), "id"))
    write_enriched(more, path)
    fold(spark, path, below=1 << 62)
    vacuum(spark, path, older_than_hours=0)
    rows = read_enriched(spark, path).filter(~F.col("id").startswith("again-"))
    return rows.select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "original_text", "cleaned_text", "sentiment_label",
        F.round(F.col("confidence_score").cast("double"), 4).alias("confidence"), "inference_error",
    )


@query("kpi_from_sums", KPI_SQL)
def _(spark, sf_dir):
    """Headline figures from the sums beside several writes, some of them folded; posts are not read."""
    path = _filled(spark, sf_dir, 4)
    fold(spark, path)
    return sums.kpi_summary(read_sums(spark, path))


@query(
    "mix_from_sums",
    f"""WITH {LABELLED_SQL} SELECT sentiment_label, count(*) AS n,
      round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM labelled GROUP BY 1""",
)
def _(spark, sf_dir):
    return sums.mix(read_sums(spark, _filled(spark, sf_dir, 3)))


@query(
    "failures_from_sums",
    f"""WITH {LABELLED_SQL} SELECT coalesce(inference_error, 'none') AS inference_error, count(*) AS n,
      round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM labelled GROUP BY 1""",
)
def _(spark, sf_dir):
    return sums.failure_rate(read_sums(spark, _filled(spark, sf_dir, 3)))


def _arrive(waves, topic, start):
    """Each wave lands as files of many tasks and is one micro-batch of one checkpoint, however many files it has."""
    for wave in waves:
        wave.write.mode("append").parquet(topic)
        enrich.run(start(wave.sparkSession.readStream.schema(wave.schema).parquet(topic)))


def _thirds(spark, sf_dir):
    """All messages in three parts, dealt out by a hash."""
    landed = scratch_table(messages(spread_posts(spark, sf_dir)).select("value"), "landed")
    return [landed.filter(F.pmod(F.xxhash64("value"), F.lit(3)) == k) for k in range(3)]


@query("stream_late_trend", TREND_SQL)
def _(spark, sf_dir):
    """Days that arrive newest first, a micro-batch each third of them: late rows add to the sums of windows long past."""
    folder = scratch_dir(spark, "late")
    landed = scratch_table(spread_posts(spark, sf_dir), "landed")
    day = F.floor(F.unix_seconds("timestamp") / 86400)
    newest = landed.agg(F.max(day)).first()[0] or 0
    late = F.least(F.floor((newest - day) / 10), F.lit(2))

    def start(source):
        rows = labelled_from(source).select(*schemas.STORED.fieldNames())
        return enrich.write_stream(rows, f"{folder}/store", f"{folder}/checkpoint", trigger=None)

    _arrive([landed.filter(late == k) for k in range(3)], f"{folder}/topic", start)
    return _shown(sums.sentiment_trend(read_sums(spark, f"{folder}/store")))


@query("stream_replayed", _STORED_SQL)
def _(spark, sf_dir):
    """All messages arrive twice, some within a micro-batch, some in a later one; each id is stored once."""
    folder = scratch_dir(spark, "replay")
    a, b, c = _thirds(spark, sf_dir)

    def start(source):
        enriched = enrich.enrich(enrich.without_replays(source), lambda df: score(df, keyword_scorer))
        return enrich.write_stream(enriched, f"{folder}/store", f"{folder}/checkpoint", trigger=None)

    _arrive([a.union(a).union(b), b.union(c), c], f"{folder}/topic", start)
    return _stored(read_enriched(spark, f"{folder}/store"))


def _remembered(spark, sf_dir):
    """A store and a table of answers, filled by a stream of three micro-batches."""
    folder = scratch_dir(spark, "remember")

    def to_enriched(batch):
        return enrich.enrich(batch, lambda df: score_distinct(df, keyword_scorer, remember=f"{folder}/answers"))

    def start(source):
        return enrich.write_stream_batches(source, to_enriched, f"{folder}/store", f"{folder}/checkpoint", trigger=None)

    _arrive(_thirds(spark, sf_dir), f"{folder}/topic", start)
    return folder


@query("stream_remembered", _STORED_SQL)
def _(spark, sf_dir):
    """Later micro-batches take the answers of earlier ones; the stored posts are those of any other way of scoring."""
    return _stored(read_enriched(spark, f"{_remembered(spark, sf_dir)}/store"))


@query(
    "answers_asked_once",
    f"""WITH {POSTS_SQL}, c AS (SELECT {clean_sql('tweet_text')} AS cleaned_text FROM posts)
    SELECT sha256(cleaned_text) AS key, 1::BIGINT AS answers FROM c WHERE trim(cleaned_text) <> '' GROUP BY cleaned_text""",
)
def _(spark, sf_dir):
    """How often each text was answered over all micro-batches."""
    answers = read_answers(spark, f"{_remembered(spark, sf_dir)}/answers")
    return answers.groupBy("key").agg(F.count(F.lit(1)).alias("answers"))
