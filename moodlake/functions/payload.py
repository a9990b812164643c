"""JSON in and out of the broker."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from moodlake import schemas
from moodlake.functions.text import _col


def post_json(id: Column | str, timestamp: Column | str, tweet_text: Column | str) -> Column:
    """One post as JSON text. NULL fields are left out."""
    return F.to_json(F.struct(
        _col(id).alias("id"), _col(timestamp).alias("timestamp"), _col(tweet_text).alias("tweet_text"),
    ))


def parse_post(value: Column | str) -> Column:
    """Broker value (binary or text) to a post struct; bad JSON gives NULL fields."""
    return F.from_json(_col(value).cast("string"), schemas.POST)


def parse_score(value: Column | str) -> Column:
    """A scorer's JSON answer to a score struct."""
    return F.from_json(_col(value), schemas.SCORE)
