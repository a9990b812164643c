"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.session import scratch_dir, scratch_table  # noqa: F401  (re-exported)

# Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
# A key with more than this share of the rows is joined by broadcast: there are fewer than HOT_SHARE such keys.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column | str) -> Column:
    """Words of a text: maximal runs without white space; none for NULL."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACES), "")


def join_hot(left: DataFrame, lookup: DataFrame, key: str, rows: str, hint: str | None = None, how: str = "left") -> DataFrame:
    """Left join with a lookup of one row per key, whatever share of ``left`` a key has.

    ``rows`` is the lookup's column with the key's number of rows in ``left``.
    Keys above a thousandth of all rows (fewer than a thousand keys, whatever
    the size of the data) come by broadcast; the others by a shuffle join in
    which no key is large. NULL keys find nothing and are dealt with apart.
    ``hint`` names the kind of that join where it should not depend on sizes.
    ``how="inner"`` leaves out the rows that find nothing, before they are shuffled or joined where that can be told.
    """
    total = lookup.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    values = [c for c in lookup.columns if c not in (key, rows)]
    is_hot = F.col(rows) * HOT_SHARE > F.lit(total)
    hot = lookup.filter(is_hot).select(key, F.struct(*values).alias("_hot"))
    cold = lookup.filter(~is_hot).select(key, *values)
    cold = cold.hint(hint) if hint else cold
    if how == "inner":
        first = left.join(F.broadcast(hot), key).select(*left.columns, *[F.col(f"_hot.{c}").alias(c) for c in values])
        rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
        return first.unionByName(rest.select(*left.columns, *values))
    marked = left.join(F.broadcast(hot), key, "left")
    first = marked.filter(F.col("_hot").isNotNull() | F.col(key).isNull())
    rest = marked.filter(F.col("_hot").isNull() & F.col(key).isNotNull()).drop("_hot").join(cold, key, "left")
    found = [F.col(f"_hot.{c}").alias(c) for c in values]
    return first.select(*left.columns, *found).unionByName(rest.select(*left.columns, *values))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder of ``spark.checkpoint.dir``; Spark removes the files when they are no longer used."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="moodlake-"))
    return df.checkpoint(eager=True)


def per_worker(name: str, key: tuple, make: Callable[[], Any]) -> Any:
    """Something costly made once per Python worker and kept for its later tasks; one per name.

    Functions travel to workers by value, so a module of this package need not
    exist there; what is kept hangs on a module that every worker can make.
    """
    held = sys.modules.setdefault("_moodlake_worker", ModuleType("_moodlake_worker")).__dict__
    if name not in held or held[name][0] != key:
        held[name] = (key, make())
    return held[name][1]
