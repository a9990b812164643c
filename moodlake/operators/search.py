"""Questions to the enriched store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moodlake.operators.metrics import mix

TEXT_COLUMNS = ("original_text", "cleaned_text")


def label_count(df: DataFrame, label: str = "Positive") -> DataFrame:
    """Posts of one label; over the store this opens that label's folder only."""
    return df.filter(F.col("sentiment_label") == label).agg(F.count(F.lit(1)).alias("n"))


def text_search(
    df: DataFrame, term: str, columns: tuple[str, ...] = TEXT_COLUMNS, regex: bool = False
) -> DataFrame:
    """Posts with the term (or a match of the pattern) in any of the columns."""
    hit = F.lit(False)
    for name in columns:
        c = F.col(name)
        found = F.rlike(c, F.lit(term)) if regex else F.contains(c, F.lit(term))
        hit = hit | found
    return df.filter(hit)


def term_mix(
    df: DataFrame, term: str, as_of: Column, hours: int = 1, columns: tuple[str, ...] = TEXT_COLUMNS
) -> DataFrame:
    """Sentiment mix of the posts with the term in the hours up to ``as_of``."""
    since = as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    recent = df.filter((F.col("timestamp") > since) & (F.col("timestamp") <= as_of))
    return mix(text_search(recent, term, columns), "sentiment_label")
