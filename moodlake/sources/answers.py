"""Answers of a model, kept so that a text is asked about once and never again.

A table of one row per text (its SHA-256, label and score), in folders that a commit makes count (``commits``), partitioned by
the first two digits of the hash. A look-up reads the key column of the partitions its texts fall into and is joined
before the model is called; only answers without an error are kept. Keep one table per model and version of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from moodlake.session import scratch_table
from moodlake.sources import commits

SCHEMA = "key string, label string, score float, bucket string"


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """``key``, ``label``, ``score``, ``bucket``; a text that two writers asked about at once has a row of each."""
    path = path.rstrip("/")
    state = commits.read_state(spark, path)
    if state is None or not state.live:
        return spark.createDataFrame([], SCHEMA)
    folders = [f"{path}/{name}" for name in sorted(state.live)]
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(*folders).select("key", "label", "score", "bucket")


def known(keys: DataFrame, path: str) -> DataFrame:
    """``key``, ``label`` and ``score`` of those ``keys`` that have an answer, stored; one row each.

    Spark sends the keys to all tasks where they are few, and else filters the table by a Bloom filter of them before the
    shuffle. At most 256 partition names reach the driver.
    """
    spark = keys.sparkSession
    buckets = [r.bucket for r in keys.select(_bucket().alias("bucket")).distinct().collect()]
    table = read_answers(spark, path).filter(F.col("bucket").isin(buckets))
    met = table.join(keys.select("key"), "key", "left_semi")
    one = met.groupBy("key").agg(F.min(F.struct("label", "score")).alias("a"))
    return scratch_table(one.select("key", "a.label", "a.score"), "known-answers")


def remember(answers: DataFrame, path: str) -> None:
    """Add ``key``, ``label``, ``score`` of texts that had no answer."""
    path, folder = path.rstrip("/"), f"write=answers-{uuid.uuid4().hex}"
    rows = answers.select("key", "label", "score", _bucket().alias("bucket"))
    rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/{folder}")
    commits.commit(answers.sparkSession, path, {folder: -1})


def fold(spark: SparkSession, path: str) -> int | None:
    """Put all folders into one, in one commit; look-ups and writers go on meanwhile. None if there are not two."""
    path = path.rstrip("/")
    state = commits.read_state(spark, path)
    if state is None or len(state.live) < 2:
        return None
    folder = f"write=fold-{uuid.uuid4().hex}"
    rows = read_answers(spark, path).groupBy("bucket", "key").agg(F.min(F.struct("label", "score")).alias("a"))
    rows = rows.select("key", "a.label", "a.score", "bucket").repartition("bucket").sortWithinPartitions("bucket", "key")
    rows.write.partitionBy("bucket").parquet(f"{path}/{folder}")
    return commits.commit(spark, path, {folder: -1}, removes=sorted(state.live))


def _bucket():
    return F.substring("key", 1, 2)
