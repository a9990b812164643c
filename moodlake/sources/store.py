"""The enriched store: Parquet in one folder per write, partitioned by sentiment_label, and a log of the writes that count.

Layout: ``write=<name>/sentiment_label=<label>/``, ``_commits/`` and ``_sums/``. A write's folder is new, and readers see
it only once the whole of it is committed (``commits``): a crashed write, a repeated micro-batch or a fold under way is
never half seen. A stream's commits carry its batch number, so a repeated batch is stored once. Streams, restarts and
backfills share one store. ``fold`` replaces many writes by one in a single commit.

Beside each write lie its sums by hour, label and error (``sums``), so that reports need not read posts.

Stores of older layouts (labels or batch numbers at the top, writes without a log) are read along with it.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from moodlake import schemas
from moodlake.operators.sums import hourly_sums, merged
from moodlake.sources import commits

# Top folders of older layouts and bare files.
LAYOUTS = ("sentiment_label=*", "batch_id=*", "*.parquet")
SUMS = "_sums"
SMALL_ROWS = 5_000_000


class EmptyStore(RuntimeError):
    """The store exists but holds no rows."""


def _if_there(spark: SparkSession, path: str, patterns: list[str], schema: StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{p}" for p in patterns])
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_enriched(spark: SparkSession, path: str, cache: bool = False, version: int | None = None) -> DataFrame:
    """Scan the store as of the newest commit, or of ``version``; labels come from the folder names.

    ``inference_error`` is NULL where a store has no such column. A missing
    path raises Spark's own analysis error, an empty store raises
    ``EmptyStore``; finding one row is enough to tell. ``cache`` persists
    before anything is counted, so later counts fill the cache.
    """
    path, names = path.rstrip("/"), schemas.STORED.fieldNames()
    state = commits.read_state(spark, path, version)
    writes = ["write=*"] if state is None else sorted(state.live)
    groups = [*([writes] if writes else []), *[[p] for p in LAYOUTS]]
    parts = [df.select(*names) for g in groups if (df := _if_there(spark, path, g, schemas.STORED)) is not None]
    if not parts:
        parts = [spark.read.schema(schemas.STORED).parquet(path)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    if cache:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    if rows.isEmpty():
        raise EmptyStore(f"no rows in {path}")
    return rows


def _write(rows: DataFrame, path: str, name: str) -> None:
    rows.write.partitionBy("sentiment_label").parquet(f"{path}/{name}")


def _add_sums(rows: DataFrame, path: str, name: str) -> int:
    """Store the sums of a finished write, from its own columns; its number of rows. Rows of another shape are only counted."""
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/{name}")
    if "inference_error" not in written.columns:
        written = written.withColumn("inference_error", F.lit(None).cast("string"))
    kinds = {f.name: f.dataType for f in written.schema.fields}
    if any(kinds.get(f.name) != f.dataType for f in schemas.STORED.fields):
        return written.count()
    hourly_sums(written).write.parquet(f"{path}/{SUMS}/{name}")
    return _rows_of(rows.sparkSession, path, name)


def _rows_of(spark: SparkSession, path: str, name: str) -> int:
    return spark.read.parquet(f"{path}/{SUMS}/{name}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def store_batch(rows: DataFrame, path: str, name: str, batch: tuple[str, int] | None = None) -> int | None:
    """Write rows of the stored shape to a folder of their own and commit it; the version, or None where the stream's batch
    is stored already. ``name`` only makes the folder readable."""
    spark, path = rows.sparkSession, path.rstrip("/")
    if batch and (state := commits.read_state(spark, path)) and state.batches.get(batch[0], -1) >= batch[1]:
        return None
    folder = f"write={name}-{uuid.uuid4().hex[:12]}"
    _write(rows, path, folder)
    n = _add_sums(rows, path, folder)
    return commits.commit(spark, path, {folder: n} if n else {}, batch=batch)


def write_enriched(rows: DataFrame, path: str, compact: bool = False) -> None:
    """Add enriched posts as one batch, for backfills.

    Each task writes its own file per label, without a shuffle. Sorting by time
    inside a file keeps row-group statistics narrow, so time filters skip data.
    ``compact`` shuffles first, for input in many small pieces; the rebalance
    hint keeps three labels from becoming three writing tasks, since adaptive
    execution splits a label's rows into even parts.
    """
    if "inference_error" not in rows.columns:
        rows = rows.withColumn("inference_error", F.lit(None).cast("string"))
    store_batch(_in_order(rows.select(*schemas.STORED.fieldNames()), compact), path, "batch")


def _in_order(rows: DataFrame, compact: bool) -> DataFrame:
    if compact:
        rows = rows.hint("rebalance", "sentiment_label")
    return rows.sortWithinPartitions("sentiment_label", "timestamp")


def fold(spark: SparkSession, path: str, below: int = SMALL_ROWS) -> int | None:
    """Replace all writes of fewer than ``below`` rows by one, in one commit; its version, or None if there are not two.

    Readers see the old folders or the new one, never both or neither. Writers go on meanwhile. Of two folds at once the
    second one to commit raises ``commits.Conflict`` and changes nothing. Sums are added up, not counted again.
    """
    path = path.rstrip("/")
    state = commits.read_state(spark, path)
    if state is None:
        found = commits.existing_writes(spark, path)
        if not found:
            return None
        commits.commit(spark, path, {})
        state = commits.read_state(spark, path)
    old = sorted(n for n, rows in state.live.items() if rows < below)
    if len(old) < 2:
        return None
    rows = _if_there(spark, path, old, schemas.STORED).select(*schemas.STORED.fieldNames())
    folder = f"write=fold-{uuid.uuid4().hex[:12]}"
    _write(_in_order(rows, compact=True), path, folder)
    counted = _summed(spark, path, old)
    merged(counted).write.parquet(f"{path}/{SUMS}/{folder}")
    return commits.commit(spark, path, {folder: _rows_of(spark, path, folder)}, removes=old)


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 72) -> list[str]:
    """Remove folders that no longer count, with their sums (see ``commits.vacuum``)."""
    gone = commits.vacuum(spark, path.rstrip("/"), older_than_hours)
    files = commits.Files(spark, path)
    for name in gone:
        files.delete(f"{SUMS}/{name}")
    return gone


def _summed(spark: SparkSession, path: str, writes: list[str]) -> DataFrame:
    """Sums of these writes; writes from before there were sums are counted now."""
    has = commits.Files(spark, path).names(SUMS)
    parts = []
    if with_sums := [f"{path}/{SUMS}/{n}" for n in writes if n in has]:
        parts.append(spark.read.parquet(*with_sums))
    if without := [n for n in writes if n not in has]:
        parts.append(hourly_sums(_if_there(spark, path, without, schemas.STORED)))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both


def read_sums(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Sums of the store by hour, label and error, from the small tables beside its writes; posts are not read."""
    path = path.rstrip("/")
    state = commits.read_state(spark, path, version)
    if state is None or any(_if_there(spark, path, [p], schemas.STORED) is not None for p in LAYOUTS):
        return hourly_sums(read_enriched(spark, path, version=version))
    if not state.live:
        raise EmptyStore(f"no rows in {path}")
    return merged(_summed(spark, path, sorted(state.live)))
