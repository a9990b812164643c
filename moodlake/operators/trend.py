"""Sentiment over time and the newest posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moodlake.functions.predictions import LABELS
from moodlake.operators.metrics import _share

# Trend points shown per view.
VIEWS = {"Day": 7, "Week": 14, "Month": 28}


def sentiment_trend(
    df: DataFrame,
    width: str = "1 day",
    timestamp: str = "timestamp",
    label: str = "sentiment_label",
    watermark: str | None = None,
) -> DataFrame:
    """Share of each label per window of all its posts.

    On a stream give a ``watermark``: it bounds the state, and posts later than
    it are dropped. A window with a third of all posts is no burden, since
    counts are combined before the shuffle.
    """
    if watermark:
        df = df.withWatermark(timestamp, watermark)
    counts = df.groupBy(F.window(timestamp, width)).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(label) == v).alias(f"_{v}") for v in LABELS],
    )
    labelled = sum((F.col(f"_{v}") for v in LABELS), F.lit(0))
    return counts.select(
        F.col("window.start").alias("window_start"), "n",
        *[_share(F.col(f"_{v}"), labelled).alias(f"{v.lower()}_pct") for v in LABELS],
    )


def sampled_trend(trend: DataFrame, width_seconds: int = 86400, every: int = 3) -> DataFrame:
    """Every third point, counted from the epoch."""
    index = F.floor(F.unix_seconds("window_start") / width_seconds)
    return trend.filter(F.pmod(index, F.lit(every)) == 0)


def last_points(trend: DataFrame, view: str = "Month") -> DataFrame:
    """The newest 7, 14 or 28 points, oldest first."""
    return trend.orderBy(F.desc("window_start")).limit(VIEWS[view]).orderBy("window_start")


def recent_feed(df: DataFrame, n: int = 7, timestamp: str = "timestamp", id: str = "id") -> DataFrame:
    """The newest ``n`` posts; each task keeps only its own top ``n``."""
    return df.orderBy(F.desc(timestamp), F.desc(id)).limit(n)
