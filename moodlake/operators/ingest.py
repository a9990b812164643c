"""From raw rows to validated posts and broker messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from moodlake.functions.payload import post_json
from moodlake.functions.text import is_blank, strip
from moodlake.functions.timestamps import iso_text, parse_timestamp
from moodlake.schemas import REQUIRED_COLUMNS

MISSING_COLUMN = "missing_column"
EMPTY_TEXT = "empty_text"


def tag_rejects(rows: DataFrame) -> DataFrame:
    """Add ``reject_reason``: NULL for a valid row. One pass, nothing is dropped."""
    if not set(REQUIRED_COLUMNS) <= set(rows.columns):
        return rows.withColumn("reject_reason", F.lit(MISSING_COLUMN))
    reason = F.when(is_blank("tweet_text"), EMPTY_TEXT)
    if "missing_columns" in rows.columns:  # files of a CSV scan differ in their headers
        reason = F.when(F.col("missing_columns").isNotNull(), MISSING_COLUMN).otherwise(reason)
    return rows.withColumn("reject_reason", reason)


def validate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) as two views of the tagged rows.

    Writing both scans the input twice; to scan once, write ``tag_rejects``
    partitioned by ``reject_reason``.
    """
    tagged = tag_rejects(rows)
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, tagged.filter(F.col("reject_reason").isNotNull())


def normalise(valid: DataFrame, default_ts: Column | None = None) -> DataFrame:
    """id, timestamp, tweet_text, ts_defaulted: stripped fields and real timestamps.

    ``ts_defaulted`` marks rows whose timestamp text could not be read; they
    carry ``default_ts`` or NULL.
    """
    parsed = valid.select(
        strip(F.col("id").cast("string")).alias("id"),
        parse_timestamp("timestamp").alias("timestamp"),
        strip("tweet_text").alias("tweet_text"),
    )
    unread = F.col("timestamp").isNull()
    value = F.col("timestamp") if default_ts is None else F.coalesce("timestamp", default_ts)
    return parsed.select("id", value.alias("timestamp"), "tweet_text", unread.alias("ts_defaulted"))


def messages(posts: DataFrame) -> DataFrame:
    """Normalised posts as broker messages: one JSON ``value`` per post."""
    return posts.select(post_json("id", iso_text("timestamp"), "tweet_text").alias("value"))


def observe_counts(tagged: DataFrame, observation: Observation | str = "ingest") -> DataFrame:
    """Attach running counts to a tagged frame; they cost no extra pass and are
    read from the observation or, on a stream, from the query progress."""
    return tagged.observe(
        observation,
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def reject_counts(tagged: DataFrame) -> DataFrame:
    """Rows by outcome; valid rows count as ``accepted``."""
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return tagged.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))
