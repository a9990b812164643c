"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs whatever the cluster size. Master, memory and
# executor counts belong to spark-submit and are not set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.schemaInference": "false",
}


def build_session(
    app_name: str = "moodlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or reuse) a session; shuffle sizing is an argument, not a constant."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_scopes = threading.local()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="moodlake-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder named by ``spark.checkpoint.dir``.

    A local folder is used only for a local master with that setting unset: on
    a cluster another executor could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    path = f"{root.rstrip('/')}/moodlake/{name}-{uuid.uuid4().hex}"
    for scope in getattr(_scopes, "open", [])[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, at the end; tables read from them are gone then."""
    stack = _scopes.__dict__.setdefault("open", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly, three tasks per core.

    Scans go by bytes: a compact table is read by few tasks, however much work its rows are. Spark moves filters that follow
    below the exchange, so store what is dear before filtering by it.
    """
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage: lost executors re-read files instead of repeating the
    work (model calls above all).
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
