"""Repeatable train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def split_bucket(key: str) -> Column:
    """0..99 from the key's md5: the same whatever the partitioning or file order."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100


def hash_split(df: DataFrame, key: str = "id", train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) by hash of the key; rows without a key go to the test side."""
    is_train = F.coalesce(split_bucket(key) < train_pct, F.lit(False))
    return df.filter(is_train), df.filter(~is_train)
