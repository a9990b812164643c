"""Sums of posts by hour, label and error: small, additive, enough for counts, shares, means, trends and failure rates.

Sums of parts of a table add up to those of the table, whatever order the parts come in, so a late post only adds to the
sums of its hour, and a report over many writes reads their sums alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moodlake.functions.predictions import LABELS
from moodlake.functions.display import alert_badge
from moodlake.operators.metrics import _share

KEYS = ("hour", "sentiment_label", "inference_error")


def hourly_sums(posts: DataFrame) -> DataFrame:
    """Per hour (NULL for posts without a time), label and error: ``n``, number and sum of scores, first and last time."""
    score = F.col("confidence_score").cast("double")
    return posts.groupBy(
        F.date_trunc("hour", "timestamp").alias("hour"), "sentiment_label", "inference_error",
    ).agg(
        F.count(F.lit(1)).alias("n"), F.count(score).alias("scored"), F.coalesce(F.sum(score), F.lit(0.0)).alias("score_sum"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
    )


def merged(sums: DataFrame) -> DataFrame:
    """Sums of several parts, added up."""
    return sums.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in ("n", "scored", "score_sum")], F.min("first").alias("first"), F.max("last").alias("last"),
    )


def _counts(sums: DataFrame, by: str) -> DataFrame:
    counts = sums.groupBy(by).agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.round(100.0 * F.col("n") / total, 6))


def mix(sums: DataFrame) -> DataFrame:
    """``metrics.mix`` by label."""
    return _counts(sums, "sentiment_label")


def failure_rate(sums: DataFrame) -> DataFrame:
    """``metrics.failure_rate``."""
    return _counts(sums.withColumn("inference_error", F.coalesce("inference_error", F.lit("none"))), "inference_error")


def _labelled() -> list[Column]:
    return [F.coalesce(F.sum(F.when(F.col("sentiment_label") == v, F.col("n"))), F.lit(0)).alias(f"_{v}") for v in LABELS]


def kpi_summary(sums: DataFrame) -> DataFrame:
    """``metrics.kpi_summary``."""
    one = sums.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.try_divide(F.sum("score_sum"), F.sum("scored")).alias("_mean"),
        (F.unix_micros(F.max("last")) - F.unix_micros(F.min("first"))).alias("_span"), *_labelled(),
    )
    labelled = sum((F.col(f"_{v}") for v in LABELS), F.lit(0))
    return one.select(
        "total", F.round(100 * F.col("_mean"), 1).alias("mean_confidence_pct"),
        F.round(F.try_divide(F.col("total") * 1e6, F.col("_span")), 6).alias("posts_per_second"),
        alert_badge("total").alias("alerts"), _share(F.col("_Positive"), labelled).alias("positive_pct"),
    )


def sentiment_trend(sums: DataFrame, width: str = "1 day") -> DataFrame:
    """``trend.sentiment_trend`` over windows of whole hours. Late posts are in it as soon as their write is."""
    counts = sums.filter("hour IS NOT NULL").groupBy(F.window("hour", width)).agg(F.sum("n").alias("n"), *_labelled())
    labelled = sum((F.col(f"_{v}") for v in LABELS), F.lit(0))
    return counts.select(
        F.col("window.start").alias("window_start"), "n",
        *[_share(F.col(f"_{v}"), labelled).alias(f"{v.lower()}_pct") for v in LABELS],
    )
