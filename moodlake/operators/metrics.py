"""Counts, shares and headline figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moodlake.functions.display import alert_badge
from moodlake.functions.predictions import LABELS

# Where posts come from.
SOURCES = ("twitter", "reddit", "news", "other")


def class_distribution(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Rows per label, largest first, ties by label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)


def mix(df: DataFrame, by: str = "sentiment_label") -> DataFrame:
    """Rows and percentage share per value of a column.

    The total comes from the counts themselves: both read one exchange of
    partial counts, so the rows are scanned once and no task sees all values.
    """
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.round(100.0 * F.col("n") / total, 6))


def _share(n: Column, total: Column) -> Column:
    """Percentage with an empty total taken as one."""
    return F.round(100.0 * n / F.greatest(total, F.lit(1)), 6)


def mix_row(df: DataFrame, by: str = "sentiment_label", values: tuple[str, ...] = LABELS) -> DataFrame:
    """The mix over fixed values as one row; also fits a stream in complete or
    update mode, where its state is a single row."""
    counts = df.agg(*[F.count_if(F.col(by) == v).alias(f"{v.lower()}_n") for v in values])
    total = sum((F.col(f"{v.lower()}_n") for v in values), F.lit(0))
    return counts.select("*", *[_share(F.col(f"{v.lower()}_n"), total).alias(f"{v.lower()}_pct") for v in values])


def kpi_summary(
    df: DataFrame,
    label: str = "sentiment_label",
    confidence: str = "confidence_score",
    timestamp: str = "timestamp",
) -> DataFrame:
    """Total, mean confidence (percent), posts per second, alerts, positive share: one row."""
    sums = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.avg(F.col(confidence).cast("double")).alias("_mean"),
        (F.unix_micros(F.max(timestamp)) - F.unix_micros(F.min(timestamp))).alias("_span"),
        *[F.count_if(F.col(label) == v).alias(f"_{v}") for v in LABELS],
    )
    labelled = sum((F.col(f"_{v}") for v in LABELS), F.lit(0))
    return sums.select(
        "total",
        F.round(100 * F.col("_mean"), 1).alias("mean_confidence_pct"),
        F.round(F.try_divide(F.col("total") * 1e6, F.col("_span")), 6).alias("posts_per_second"),
        alert_badge("total").alias("alerts"),
        _share(F.col("_Positive"), labelled).alias("positive_pct"),
    )


def throughput(df: DataFrame, width: str = "1 hour", timestamp: str = "timestamp", watermark: str | None = None) -> DataFrame:
    """Posts per window and per second of it."""
    if watermark:
        df = df.withWatermark(timestamp, watermark)
    counts = df.groupBy(F.window(timestamp, width)).agg(F.count(F.lit(1)).alias("n"))
    seconds = (F.unix_micros("window.end") - F.unix_micros("window.start")) / F.lit(1e6)
    return counts.select(
        F.col("window.start").alias("window_start"), "n",
        F.round(F.col("n") / seconds, 6).alias("posts_per_second"),
    )


def failure_rate(df: DataFrame, error: str = "inference_error") -> DataFrame:
    """Rows and share per error; rows without one count as ``none``."""
    return mix(df.select(F.coalesce(error, F.lit("none")).alias(error)), error)
