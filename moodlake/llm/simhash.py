"""Near duplicates by SimHash: 64-bit fingerprints, deletion-variant signatures, components.

Two fingerprints that differ in at most three bits differ in at most one bit
in one of their two halves. So each half is indexed 33 times: as it is, and
with each of its bits left out. Halves that are equal meet in the first list;
halves that differ in one bit meet in that bit's list, on opposite sides. Every
link is thus found by equality of a signature and then verified on all 64 bits.

Copies share one fingerprint, and signatures are made of distinct fingerprints
only, so that a group of copies is one row however large. Signatures are counted
with partial sums; two fingerprints that share one are verified on the spot. A
signature shared by more is cut into blocks by a hash, so that no task gathers
all of it; a task compares two blocks and gives a spanning forest of their
links, never all pairs.

Defined results: texts without words, NULL included, have fingerprint zero and
are linked like any other; repeated rows have the same fingerprint; a NULL id
counts as larger than any other, so it is a class id only where there is no other; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import join_hot, scratch_table
from moodlake.llm.components import stars

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# Fingerprints of one signature that a task compares with as many others.
BLOCK = 512
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    tokens = (text or "").encode().lower().split()  # on bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) < shingle:
        parts = [b" ".join(tokens)]
    else:
        parts = map(b" ".join, zip(*[tokens[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(p, seed) for p in parts]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), ROWS_AT_ONCE):
        ones += np.unpackbits(hashes[i:i + ROWS_AT_ONCE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Replace the text by ``fp``, the fingerprint as a signed long."""
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(text)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(found.view(np.int64))], names=[*keep, "fp"])

    fields = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep], "fp bigint"])
    return docs.select(*keep, text).mapInArrow(run, fields)


def signatures(distinct: DataFrame) -> DataFrame:
    """``key``, ``fp``, ``side``: 33 signatures of each half of a distinct fingerprint.

    List 0 of a half holds it whole (side 0); list p + 1 holds it without bit p, the bit being the side.
    """
    listed = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("list"))
    half = F.expr("shiftrightunsigned(fp, 32 * (list div 33)) & 4294967295L")
    bit = F.expr("IF(list % 33 = 0, 0L, shiftleft(1L, list % 33 - 1))")
    return listed.select("fp", "list", half.alias("half"), bit.alias("bit")).select(
        F.expr("shiftleft(CAST(list AS BIGINT), 32) | (half & ~bit)").alias("key"), "fp",
        F.expr("half & bit <> 0").cast("int").alias("side"), (F.col("bit") == 0).alias("whole"),
    )


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that hold together the same fingerprints as all links do."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
    left = np.ones(len(fps), bool)
    links = []
    for i in range(len(fps)):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            k = todo.pop()
            found = np.flatnonzero(near[k] & left)
            left[found] = False
            links += [(k, j) for j in found]
            todo += found.tolist()
    return links


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints that connect whatever differs in at most ``max_bits`` bits."""
    if max_bits > 3:
        raise ValueError("two halves find differences of at most three bits")
    # A row becomes 66 signatures, so the few tasks that read a small table are not enough; a stated number is not merged.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = signatures(distinct.repartition(tasks, "fp"))
    keys = met.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"),
        (F.max("whole") | (F.min("side") < F.max("side"))).alias("meets"),
    ).filter("n > 1 AND meets")
    keys = scratch_table(keys.select("key", "n", "a", "b"), "signatures")
    two = keys.filter(f"n = 2 AND bit_count(a ^ b) <= {max_bits}").select("a", "b")
    many = keys.filter("n > 2").selectExpr("key", "n", f"(n + {block - 1}) div {block} AS blocks")
    blocks = join_hot(met.select("key", "fp"), many, "key", "n", how="inner").selectExpr(
        "key", "fp", "pmod(xxhash64(fp), blocks) AS own", "blocks"
    )
    paired = blocks.select(
        "key", "fp", F.explode(F.expr("transform(sequence(0L, blocks - 1), x -> struct(least(x, own) AS lo, greatest(x, own) AS hi))")).alias("p")
    ).select("key", "p.lo", "p.hi", "fp")
    paired = paired.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.column_stack([batch.column(i).to_numpy() for i in range(4)])])
            starts = _starts(held)
            yield _linked(held[:starts[-1]], starts[:-1], max_bits)
            held = held[starts[-1]:]
        if len(held):
            yield _linked(held, _starts(held), max_bits)

    return two.unionByName(paired.mapInArrow(run, "a bigint, b bigint")).distinct()


def _starts(rows: np.ndarray) -> np.ndarray:
    """Where a new (key, lo, hi) begins."""
    return np.flatnonzero(np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]))


def _linked(rows: np.ndarray, starts: np.ndarray, max_bits: int) -> pa.RecordBatch:
    fps = rows[:, 3].view(np.uint64) if rows.flags["C_CONTIGUOUS"] and rows.shape[1] == 1 else rows[:, 3].astype(np.int64).view(np.uint64)
    sizes = np.diff(np.append(starts, len(rows)))
    two = starts[sizes == 2]
    near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits] if len(two) else two
    a, b = [fps[near]], [fps[near + 1]]
    for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
        if found := _forest(fps[s:s + n], max_bits):
            i, j = np.array(found).T
            a.append(fps[s + i])
            b.append(fps[s + j])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64))], names=["a", "b"]
    )


def rooted(own: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp``, its number of rows ``n``, the smallest of their ids ``first``, and the ``root`` of its component, from ``_id`` and ``fp`` of every row."""
    counted = scratch_table(own.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first")), "distinct")
    found = stars(links(counted.select("fp"), max_bits), "a", "b")
    joined = counted.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left")
    return scratch_table(joined.select("fp", "n", "first", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``id_col``, ``fp`` (long) and ``component_id``: the smallest id that links reach, one row per row of ``docs``."""
    own = scratch_table(fingerprints(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), "_text", shingle), "fingerprints")
    found = rooted(own, max_bits)
    lowest = found.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    classes = join_hot(found, scratch_table(lowest, "lowest"), "root", "fps").select("fp", "n", "component_id")
    joined = join_hot(own, scratch_table(classes, "classes"), "fp", "n")
    return joined.select(F.col("_id").alias(id_col), "fp", "component_id")


def fingerprint_hex(fp: str = "fp"):
    """The fingerprint's 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """The smallest row of each class, its columns unchanged: by id (NULL last), then by text, then by all other columns.

    Rows are told by the MD5 of their text, never by an id: rows that share an id, or have none, stand for themselves.
    Whole rows move once, to learn their class; only rows of classes with several rows move again. Input columns are
    carried in one struct, whatever their names.
    """
    key = F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    own = fingerprints(docs.select(key.alias("_id"), F.col(f"`{text}`").alias("_text")), "_text", shingle)
    # Of equal texts the fingerprints are equal.
    texts = scratch_table(own.groupBy("_id").agg(F.count(F.lit(1)).alias("rows"), F.first("fp").alias("fp")), "texts")
    found = rooted(texts, max_bits).select("fp", "n", "root")
    placed = scratch_table(join_hot(texts, found, "fp", "n").select(F.col("_id").alias("key"), "rows", "root"), "placed")
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("texts"), F.sum("rows").alias("total")).filter("total > 1")
    several = join_hot(placed, scratch_table(sizes, "sizes"), "root", "texts").filter("total IS NOT NULL")
    lookup = scratch_table(several.select("key", "rows", F.col("root").alias("class")), "text_classes")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    # Texts are not sorted for it, and move alike at every size.
    joined = join_hot(packed, lookup, "key", "rows", hint="shuffle_hash")
    single = joined.filter("class IS NULL").select("row.*")
    company = joined.filter("class IS NOT NULL").select("class", "row")
    return single.unionByName(smallest(company, docs.columns, id_col, text))


def smallest(rows: DataFrame, columns: list[str], id_col: str, text: str) -> DataFrame:
    """One ``row`` per ``class``, unpacked: the smallest by id (NULL last), then text, then all other columns."""
    named = [id_col, text, *[c for c in columns if c not in (id_col, text)]]
    order = [F.col("row")[id_col].isNull().alias("none"), *[F.col("row")[c].alias(f"_{i}") for i, c in enumerate(named)]]
    least = rows.groupBy("class").agg(F.min(F.struct(*order)).alias("least"))
    return least.select(*[F.col("least")[f"_{named.index(c)}"].alias(c) for c in columns])
