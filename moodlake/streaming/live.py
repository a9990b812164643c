"""Live figures: streaming aggregates kept as a small table.

Each micro-batch writes a folder and commits it in place of those it makes stale (``sources.commits``), so a reader opens
the newest figures only, however long the stream has run, and never half of a batch. A batch repeated after a failure
finds itself committed. Figures of a later checkpoint go before those of an earlier one.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from moodlake.operators.trend import recent_feed
from moodlake.sources import commits
from moodlake.streaming.enrich import start, writer_id

# Where a row was stored; runs are ordered by name.
PLACE = ("run", "batch_id")
# Folders of changed rows that are read together before a batch puts them into one.
MOST_FOLDERS = 16
# How long replaced folders stay for readers that have begun.
KEEP_HOURS = 1.0


@contextmanager
def _shuffle_partitions(spark: SparkSession, n: int):
    """A query keeps the settings it was started with."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def write_updates(
    aggregate: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    trigger: str | None = "10 seconds",
    name: str | None = None,
    state_partitions: int = 8,
    keys: list[str] | None = None,
) -> StreamingQuery:
    """Store what each micro-batch changed, for ``read_latest``.

    ``mode="complete"`` stores the whole (small) result each time, in place of the one before. In update mode ``keys`` name
    the rows: after ``MOST_FOLDERS`` batches their newest rows are put into one folder. Each state partition writes files in
    every batch; the state is a row per window or label and rows are combined before the shuffle, so a few partitions do
    however large the stream.
    """
    spark = aggregate.sparkSession
    writer = writer_id(spark, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        def rows(older: list[str]) -> tuple[DataFrame, list[str]]:
            new = batch.withColumns({"run": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")})
            if mode == "complete":
                return new, older
            if keys is None or len(older) < MOST_FOLDERS:
                return new, []
            return _newest(new.unionByName(_read(batch.sparkSession, path, older)), keys), older

        _put(batch.sparkSession, path, writer, batch_id, rows)

    with _shuffle_partitions(spark, state_partitions):
        return start(aggregate.writeStream.foreachBatch(store).outputMode(mode), checkpoint, trigger, name)


def write_feed(
    posts: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 7,
    trigger: str | None = "10 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Keep the newest ``n`` posts: each micro-batch stores the newest of its own and of those stored before, in their place.
    A new checkpoint begins a new feed."""
    writer = writer_id(posts.sparkSession, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        def rows(older: list[str]) -> tuple[DataFrame, list[str]]:
            found = recent_feed(batch, n)
            own = [name for name in older if _place(name)[0] == writer]
            if own:
                earlier = batch.sparkSession.read.schema(batch.schema).parquet(f"{path.rstrip('/')}/{max(own, key=_place)}")
                found = recent_feed(found.unionByName(earlier), n)
            return found, older

        _put(batch.sparkSession, path, writer, batch_id, rows)

    return start(posts.writeStream.foreachBatch(store), checkpoint, trigger, name)


def _folder(run: str, batch_id: int) -> str:
    return f"write={run}_{batch_id:012d}_{uuid.uuid4().hex[:12]}"


def _place(folder: str) -> tuple[str, int]:
    run, batch_id, _ = folder.removeprefix("write=").split("_")
    return run, int(batch_id)


def _put(spark: SparkSession, path: str, run: str, batch_id: int, rows) -> None:
    """Store one batch: ``rows`` gives, for the older live folders, what to write and which of them that replaces."""
    path = path.rstrip("/")
    state = commits.read_state(spark, path) or commits.State()
    if state.batches.get(run, -1) >= batch_id:
        return
    found, stale = rows([f for f in state.live if _place(f) < (run, batch_id)])
    folder = _folder(run, batch_id)
    found.repartition(1).write.parquet(f"{path}/{folder}")
    commits.commit(spark, path, {folder: -1}, removes=stale, batch=(run, batch_id))
    if batch_id % commits.FULL == commits.FULL - 1:
        commits.vacuum(spark, path, KEEP_HOURS)


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path.rstrip('/')}/{f}" for f in sorted(folders)])


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row per key, with its place; without keys the newest row of all."""
    values = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*PLACE)).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col("row")[c].alias(c) for c in values])


def _live(spark: SparkSession, path: str) -> list[str]:
    state = commits.read_state(spark, path)
    if state is None or not state.live:
        raise FileNotFoundError(f"no figures in {path}")
    return list(state.live)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest batch of the newest run."""
    return _read(spark, path, [max(_live(spark, path), key=_place)])


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest stored row per key; without keys the newest row of all."""
    return _newest(_read(spark, path, _live(spark, path)), keys).drop(*PLACE)
