"""From broker rows to cleaned posts and the stored shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moodlake import schemas
from moodlake.functions.payload import parse_post
from moodlake.functions.predictions import default_label
from moodlake.functions.text import clean_text
from moodlake.functions.timestamps import iso_timestamp


def decode_posts(broker_rows: DataFrame) -> DataFrame:
    """id, timestamp, tweet_text from ``value``; unreadable JSON gives NULL fields."""
    return broker_rows.select(parse_post("value").alias("post")).select("post.*")


def clean_posts(posts: DataFrame, drop_hashtags: bool = True, trim: bool = False) -> DataFrame:
    """Keep the text as ``original_text`` and add ``cleaned_text``."""
    return posts.withColumnRenamed("tweet_text", "original_text").select(
        "id", "timestamp", "original_text",
        clean_text("original_text", drop_hashtags, trim).alias("cleaned_text"),
    )


def stored_shape(scored: DataFrame, keep_error: bool = True) -> DataFrame:
    """The columns of the enriched store; no label is NULL or empty.

    ``inference_error`` tells a failed call from a true Neutral; ``keep_error``
    leaves it out on demand.
    """
    timestamp = F.col("timestamp")
    if dict(scored.dtypes)["timestamp"] == "string":
        timestamp = iso_timestamp(timestamp)
    shaped = scored.withColumns({
        "timestamp": timestamp,
        "sentiment_label": default_label("sentiment_label"),
        "confidence_score": F.col("confidence_score").cast("float"),
    })
    if "inference_error" not in scored.columns:
        shaped = shaped.withColumn("inference_error", F.lit(None).cast("string"))
    return shaped.select(*(schemas.STORED if keep_error else schemas.ENRICHED).fieldNames())
