"""Shards of near equal size by histogram sort, under the law ``bytes``.

Every row has a key of 128 bits: a hash of its text, then a hash of its other
columns, then one of its place. Equal texts are neighbours, and a group of
copies, however large, can still be cut. The shards are ranges of keys.

The boundaries (splitters) are found by counting: each round sets candidate
boundaries (probes) inside the interval of every open splitter, all tasks count
the exact bytes and rows between neighbouring probes, and the sums narrow the
intervals to the keys met in them. A splitter is settled when a boundary lies
within the tolerance of its target, or when its interval holds a single key.
Only these sums (a few per probe) reach the driver. Then the rows are exchanged
once, by pieces: ranges of keys found in the same way, several to a shard, so
that neither a shard nor a group of copies is one task. Rows below each piece
are known from the counts, so a row's slot needs no further pass.

Defined results: NULL and empty texts have size 1 and form one group; repeated
rows are told apart by place only and share a shard or lie in neighbouring
ones; NULL ids are keys like any other; a document larger than a shard's share
fills a shard alone and others may stay empty; an empty table gives an empty
result. Columns of the input are carried in one struct, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import scratch_table

SHARDS = 8
# A shard may differ from its share by this part of it.
TOLERANCE = 0.001
# The same for pieces, which only size the tasks of the exchange.
PIECE_TOLERANCE = 0.1
PIECE_BYTES = 1 << 26
MOST_PIECES = 4096
# Probes of a round, over all open splitters together; each has 16 at least.
PROBES = 4096
HALF = 1 << 63
TOP = 1 << 128


@dataclass
class Splitter:
    """Bytes wanted below a boundary, and the interval in which it is sought: [low, high), with the bytes and rows below both."""

    target: float
    tolerance: float
    low: int
    low_bytes: int
    low_rows: int
    high: int
    high_bytes: int
    high_rows: int

    @property
    def near(self) -> tuple[int, int, int]:
        """The better end of the interval: its key, and the bytes and rows below it."""
        if self.target - self.low_bytes <= self.high_bytes - self.target:
            return self.low, self.low_bytes, self.low_rows
        return self.high, self.high_bytes, self.high_rows

    @property
    def settled(self) -> bool:
        close = self.high < TOP and abs(self.near[1] - self.target) <= self.tolerance
        return close or self.high - self.low <= 1


def packed(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Rows as a struct ``row``, with ``size``, ``crc`` and the key (``k1``, ``k2``), written once: a row's place is part of its key."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    columns = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text]
    others = [F.col(f"`{c}`").cast("string") for c in docs.columns if c != text]
    # 44 bits of the text's hash, so that equal texts are neighbours, then 20 of the row's.
    of_text = F.xxhash64(body).bitwiseAND(F.lit(-1 << 20))
    of_row = F.xxhash64(*others).bitwiseAND(F.lit((1 << 20) - 1)) if others else F.lit(0)
    rows = docs.select(
        F.struct(*columns).alias("row") if columns else F.struct(F.lit(None).cast("void").alias("none")).alias("row"),
        (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"),
        of_text.bitwiseOR(of_row).alias("k1"), F.xxhash64(F.monotonically_increasing_id()).alias("k2"),
    )
    return scratch_table(rows, "keyed")


def _halves(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys as two arrays of signed numbers, in the order of the table's columns."""
    return (
        np.array([(k >> 64) - HALF for k in keys], np.int64),
        np.array([(k & (2 * HALF - 1)) - HALF for k in keys], np.int64),
    )


def _whole(k1: int, k2: int) -> int:
    return (k1 + HALF) << 64 | (k2 + HALF)


def below(k1: np.ndarray, k2: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """How many of the ascending probes are at or below each key."""
    left, right = np.searchsorted(p1, k1, "left"), np.searchsorted(p1, k1, "right")
    for i, j in np.unique(np.column_stack([left, right])[left < right], axis=0):
        at = (left == i) & (right == j)
        left[at] += np.searchsorted(p2[i:j], k2[at], "right")
    return left


def histogram(rows: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Between neighbouring probes, if there are rows: bytes, rows, smallest and largest key."""
    p1, p2 = _halves(probes)

    def reduced(table: np.ndarray) -> np.ndarray:
        """Columns: gap, bytes, rows, smallest key, largest key (two numbers each); one line per gap."""
        table = table[np.lexsort((table[:, 4], table[:, 3], table[:, 0]))]
        starts = np.flatnonzero(np.diff(table[:, 0], prepend=-1))
        out = table[starts]
        out[:, 1:3] = np.add.reduceat(table[:, 1:3], starts, axis=0)
        table = table[np.lexsort((table[:, 6], table[:, 5], table[:, 0]))]
        out[:, 5:] = table[np.append(starts[1:], len(table)) - 1, 5:]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 7), np.int64)
        for batch in batches:
            k1, k2, size = [batch.column(c).to_numpy() for c in ("k1", "k2", "size")]
            if len(size):
                held = reduced(np.concatenate([held, np.column_stack([below(k1, k2, p1, p2), size, np.ones(len(size), np.int64), k1, k2, k1, k2])]))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T], names=names)

    names = ["gap", "bytes", "rows", "a1", "a2", "b1", "b2"]
    counted = rows.select("k1", "k2", "size").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    sums = counted.groupBy("gap").agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.min(F.struct("a1", "a2")).alias("a"), F.max(F.struct("b1", "b2")).alias("b"),
    )
    return {r.gap: (r.bytes, r.rows, _whole(*r.a), _whole(*r.b)) for r in sums.collect()}


def splitters(rows: DataFrame, shards: int, pieces: int, tolerance: float, total: int, n_rows: int) -> list[tuple[int, int, int]]:
    """Boundaries between ``shards`` x ``pieces`` ranges of near equal bytes: key, and the bytes and rows below it."""
    share = total / (shards * pieces)
    wanted = [
        Splitter(share * i, (tolerance * pieces if i % pieces == 0 else max(PIECE_TOLERANCE, tolerance)) * share, 0, 0, 0, TOP, total, n_rows)
        for i in range(1, shards * pieces)
    ]
    while open_ones := [s for s in wanted if not s.settled]:
        intervals = {(s.low, s.high) for s in open_ones}
        n = max(16, PROBES // len(intervals))
        probes = sorted({low + (high - low) * i // (n + 1) for low, high in intervals for i in range(1, n + 1)} | {k for i in intervals for k in i} - {TOP})
        gaps = histogram(rows, probes)
        upto_bytes = upto_rows = 0
        found = []
        for gap in sorted(gaps):
            size, count, first, last = gaps[gap]
            found.append((upto_bytes + size, first, upto_bytes, upto_rows, last + 1, upto_bytes + size, upto_rows + count))
            upto_bytes, upto_rows = upto_bytes + size, upto_rows + count
        ends = [f[0] for f in found]
        for s in open_ones:
            _, s.low, s.low_bytes, s.low_rows, s.high, s.high_bytes, s.high_rows = found[np.searchsorted(ends, s.target)]
    return [s.near for s in wanted]


def shard(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Rows of ``packed`` with ``shard`` and ``slot`` (from 0 without gaps, in the order of keys), sorted within pieces.

    The number of pieces follows the bytes up to ``MOST_PIECES``; beyond that pieces grow, and Spark sorts them with spilling.
    """
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    pieces = max(1, min(-(-total // (shards * piece_bytes)), MOST_PIECES // shards))
    cuts = splitters(rows, shards, pieces, tolerance, total, n_rows) if total else []
    p1, p2 = _halves([key for key, *_ in cuts])
    rows_below = np.array([0, *[n for *_, n in cuts]], np.int64)
    begins = rows_below - rows_below[np.arange(len(rows_below)) // pieces * pieces]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = below(batch.column("k1").to_numpy(), batch.column("k2").to_numpy(), p1, p2)
            found = [pa.array(piece), pa.array(piece // pieces, pa.int32()), pa.array(begins[piece])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "piece", "shard", "begin"])

    added = [T.StructField("piece", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("begin", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *added])
    placed = rows.mapInArrow(run, schema).repartition(shards * pieces, "piece")
    in_piece = F.row_number().over(Window.partitionBy("piece").orderBy("k1", "k2"))
    return placed.withColumn("slot", F.col("begin") + in_piece - 1).drop("piece", "begin", "k1", "k2")


def write(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text") -> None:
    """Write the rows of ``docs`` (struct ``row``) with their ``slot`` to folders ``shard=<n>``, each file in the order of slots."""
    shard(packed(docs, text), shards).select("row", "slot", "shard").write.partitionBy("shard").parquet(path)
