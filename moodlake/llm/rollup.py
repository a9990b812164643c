"""Token counts kept as additive totals that batches of changes update.

A batch holds inserts, deletes and revised counts of documents. It becomes
signed rows, old counts taken off and new ones put on, which are added up by
source, language and tokenizer version. Totals are the sum over committed
batches; a count is never recomputed for documents a batch does not touch.

Layout below the root: ``ledger`` (the rows a batch set, per document and
version), ``deltas`` (its signed sums) and ``commits`` (one row per batch,
written last). Both folders of a batch bear its id and replace themselves if
it is tried again; a batch whose id is among the commits does nothing, and
what an interrupted one left behind is not read.

Defined results: NULL and empty texts have no tokens; NULL sources and
languages are groups of their own. An id stands for all rows a batch has for it
under a version: repeated ids, and the rows without an id, each count with every
row, and a later batch replaces or deletes them together (deletes beside other
rows of their id have no effect). Deleting what is not there changes nothing;
inserting what is there revises it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.llm.common import per_worker, scratch_table

LEDGER = "id bigint, version string, source string, lang string, n_docs bigint, n_tokens bigint, live boolean, batch string"
DELTAS = "source string, lang string, version string, n_docs bigint, n_tokens bigint"
COMMITS = "batch string, place bigint"


def _tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    def make() -> tiktoken.Encoding:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return per_worker("tokenizer", (path, pattern), make)


def count_tokens(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Replace the text by its number of tokens."""
    keep = [c for c in docs.columns if c not in (text, out)]
    fields = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep], f"`{out}` bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path, pattern).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t.as_py() or "")) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sizes, pa.int64())], names=[*keep, out])

    return docs.select(*keep, text).mapInArrow(run, fields)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, root: str) -> dict[str, int]:
    """Committed batches and their order; one small row per batch."""
    return {r.batch: r.place for r in _read(spark, f"{root}/commits", COMMITS).collect()}


def current(spark: SparkSession, root: str) -> DataFrame:
    """The live rows of the ledger: those that the last batch set for each id and version. One scan, however many batches."""
    done = commits(spark, root)
    if not done:
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(*[f"{root}/ledger/{batch}" for batch in done])
    rows = rows.join(F.broadcast(spark.createDataFrame(list(done.items()), COMMITS)), "batch")
    last = rows.groupBy("id", "version").agg(F.max("place").alias("place")).alias("l")
    rows = rows.alias("r").join(last, _same("r", "l") & (F.col("r.place") == F.col("l.place")), "left_semi")
    return rows.filter("live").select("id", "version", "source", "lang", "n_docs", "n_tokens", "live", "batch")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & F.col(f"{a}.version").eqNullSafe(F.col(f"{b}.version"))


def commit(spark: SparkSession, root: str, batch: str, changes: DataFrame) -> bool:
    """Apply ``op`` (insert, delete, revise), ``id``, ``version``, ``source``, ``lang``, ``n_tokens``; False if done before.

    A delete needs ``id`` and ``version`` only: what it takes off is read from the ledger.
    """
    done = commits(spark, root)
    if batch in done:
        return False
    sets = changes.filter("op <> 'delete'").groupBy("id", "version", "source", "lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens")
    ).withColumn("live", F.lit(True))
    gone = changes.filter("op = 'delete'").select("id", "version").distinct().alias("d")
    gone = gone.join(changes.filter("op <> 'delete'").select("id", "version").distinct().alias("s"), _same("d", "s"), "left_anti")
    gone = gone.selectExpr("id", "version", "NULL AS source", "NULL AS lang", "0L AS n_docs", "0L AS n_tokens", "false AS live")
    new = sets.unionByName(gone).withColumn("batch", F.lit(batch))
    new.write.mode("overwrite").parquet(f"{root}/ledger/{batch}")
    new = spark.read.schema(LEDGER).parquet(f"{root}/ledger/{batch}")
    old = current(spark, root).alias("o")
    touched = old.join(new.select("id", "version").distinct().alias("n"), _same("o", "n"), "left_semi")
    signed = new.filter("live").withColumn("sign", F.lit(1)).unionByName(touched.withColumn("sign", F.lit(-1)))
    delta = signed.groupBy("source", "lang", "version").agg(
        F.sum(F.col("sign") * F.col("n_docs")).cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens")
    )
    delta.write.mode("overwrite").parquet(f"{root}/deltas/{batch}")
    marker = spark.createDataFrame([(batch, len(done))], COMMITS)
    marker.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """``source``, ``lang``, ``version``, ``n_docs``, ``n_tokens`` over all committed batches; empty groups are left out."""
    done = sorted(commits(spark, root))
    if not done:
        return spark.createDataFrame([], DELTAS)
    rows = spark.read.schema(DELTAS).parquet(*[f"{root}/deltas/{batch}" for batch in done])
    return rows.groupBy("source", "lang", "version").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    ).filter("n_docs <> 0 OR n_tokens <> 0")


def counted(docs: DataFrame, version: str, path: str, pattern: str, id_col: str = "doc_id", source: str = "source", lang: str = "lang", text: str = "text") -> DataFrame:
    """Rows of an insert batch with counts under this version, stored once."""
    lean = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = count_tokens(lean, path, pattern).withColumn("version", F.lit(version)).withColumn("op", F.lit("insert"))
    return scratch_table(rows, "counted")
