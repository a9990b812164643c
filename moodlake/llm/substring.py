"""Removal of repeated passages by seeds and extension.

Seeds are winnowed anchors: of the 13 eight-word sequences in every window of
20 consecutive words the one with the smallest hash is the window's anchor, so
equal windows have equal anchors. The anchors of all documents are counted; a
window can repeat only if its anchor does. Repeated anchors go into a bit table
of fixed size (``TABLE_BITS``, broadcast), which may pass windows that do not repeat,
never withhold one that does.

The windows around repeated anchors extend the match both ways; they are
compared by a 96-bit hash, and consecutive ones that occur earlier form the
maximal repeats. A task first settles the windows of its own rows, so that a
passage found in a third of all documents is one row per step of a task and
no longer a hot key; a shuffle by hash settles the rest.

Defined results: NULL and empty texts have no words; "earlier" goes by id, then
place in the text; a NULL id is larger than any other; rows with the same id
are one document, so that the same place in both is not earlier and both keep
it; other columns are not needed and not returned; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
SEED_WORDS = 8
SPAN = WINDOW - SEED_WORDS + 1
TABLE_BITS = 27
# Words a task handles at once, unless one text has more.
STEP = 1_000_000
LAST = (1 << 63) - 1
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shifted(x: np.ndarray, n: int, fill: int = 0) -> np.ndarray:
    return np.concatenate([x[n:], np.full(min(n, len(x)), fill, x.dtype)])


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _runs(h: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 8 and of the 20 words from each place on."""
    two = h * base + _shifted(h, 1)
    four = two * _power(base, 2) + _shifted(two, 2)
    eight = four * _power(base, 4) + _shifted(four, 4)
    sixteen = eight * _power(base, 8) + _shifted(eight, 8)
    return _mixed(eight), _mixed(sixteen * _power(base, 4) + _shifted(four, 16))


def _slide(x: np.ndarray, pick: Callable, fill: int) -> np.ndarray:
    """pick over the 13 values from each place on."""
    two = pick(x, _shifted(x, 1, fill))
    four = pick(two, _shifted(two, 2, fill))
    eight = pick(four, _shifted(four, 4, fill))
    return pick(eight, _shifted(eight, 5, fill))


class Step:
    """The words of some rows side by side, with anchors and windows."""

    def __init__(self, ids: list, texts: list) -> None:
        raw = [(t or "").encode() for t in texts]
        tokens = [r.split() for r in raw]
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        self.tags = np.array([xxhash.xxh64_intdigest(r, 42) & 0xFFFFFFFF for r in raw], np.uint64)
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(w) for t in tokens for w in t), np.uint64, int(self.sizes.sum()))
        ends = np.cumsum(self.sizes)
        self.row = np.repeat(np.arange(len(ids)), self.sizes)
        self.place = np.arange(len(h)) - np.repeat(ends - self.sizes, self.sizes)
        left = np.repeat(self.sizes, self.sizes) - self.place
        eight, self.whole = _runs(h, _B1)
        self.check = _runs(_mixed(h), _B2)[1] >> np.uint64(32)
        self.starts = left >= WINDOW
        most = np.uint64(2**64 - 1)
        seeds = np.where(left >= SEED_WORDS, eight, most)
        self.least = _slide(seeds, np.minimum, 2**64 - 1)
        # An anchor is a sequence that is the least of some window it lies in.
        highest = _slide(np.where(self.starts, self.least, np.uint64(0))[::-1], np.maximum, 0)[::-1]
        self.anchors = eight[(left >= SEED_WORDS) & (highest == eight)]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[Step]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0), batch.column(1)):
            ids.append(i.as_py())
            texts.append(t.as_py())
            size += len(texts[-1] or "") // 5
            if size >= STEP:
                yield Step(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield Step(ids, texts)


def repeated_anchors(docs: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """Bit table of the anchors found twice or more; ``2 ** bits`` bits, whatever the size of the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in _steps(batches):
            seeds, n = np.unique(step.anchors, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(n)], names=["seed", "n"])

    counted = docs.mapInArrow(run, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1")
    spot = F.expr(f"shiftrightunsigned(seed, {64 - bits})")
    cells = counted.select((spot / 64).cast("bigint").alias("cell"), spot.alias("spot")).groupBy("cell").agg(
        F.expr("bit_or(shiftleft(1L, CAST(spot % 64 AS INT)))").alias("word")
    )
    found = cells.toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["cell"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return table


def _windows(step: Step, table: np.ndarray, bits: int) -> pa.RecordBatch:
    """Windows around repeated anchors: the first of each kind here to be settled later, the others as runs of repeats."""
    spots = step.least >> np.uint64(64 - bits)
    passed = (table[(spots >> np.uint64(6)).astype(np.int64)] >> (spots & np.uint64(63))) & np.uint64(1)
    at = np.flatnonzero(step.starts & (passed == 1))
    whole, check, row, place = step.whole[at], step.check[at], step.row[at], step.place[at]
    ids, tags = step.ids[row], step.tags[row]
    order = np.lexsort((place, ids, check, whole))
    same = np.zeros(len(at), bool)
    if len(at):
        a, b = order[1:], order[:-1]
        new = (whole[a] != whole[b]) | (check[a] != check[b])
        group = np.concatenate([[0], np.cumsum(new)])
        first = order[np.flatnonzero(np.concatenate([[True], new]))][group]
        same[order] = (ids[order] != ids[first]) | (place[order] != place[first])
    # Runs of repeats in neighbouring places of a row become one.
    r = np.flatnonzero(same)
    begins = np.ones(len(r), bool)
    begins[1:] = (row[r[1:]] != row[r[:-1]]) | (place[r[1:]] != place[r[:-1]] + 1)
    heads = r[begins]
    lengths = np.diff(np.append(np.flatnonzero(begins), len(r)))
    open_ = np.flatnonzero(~same)
    n, pick = len(open_), np.concatenate([open_, heads])
    spread = _mixed(ids[heads].view(np.uint64) * _B1 + place[heads].astype(np.uint64))
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([whole[open_], spread]).view(np.int64)),
        pa.array(((tags[pick] << np.uint64(32)) | check[pick]).view(np.int64)),
        pa.array(ids[pick]),
        pa.array((place[pick] << 31 | np.concatenate([np.ones(n, np.int64), lengths]))),
        pa.array(np.concatenate([np.zeros(n, bool), np.ones(len(heads), bool)])),
    ], names=["hash", "tag", "id", "spot", "settled"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = TABLE_BITS) -> DataFrame:
    """``id``, ``tag`` and ``spots``: the places of windows that occur earlier, as runs (start << 31 | number of starts)."""
    lean = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(repeated_anchors(lean, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in _steps(batches):
            yield _windows(step, shared.value, bits)

    found = lean.mapInArrow(run, "hash bigint, tag bigint, id bigint, spot bigint, settled boolean")
    ranked = found.selectExpr(
        "id", "shiftrightunsigned(tag, 32) AS tag", "spot", "settled",
        "rank() OVER (PARTITION BY hash, tag & 4294967295L, settled ORDER BY id, shiftright(spot, 31)) AS place",
    ).filter("settled OR place > 1")
    return ranked.groupBy("id", "tag").agg(F.sort_array(F.collect_list("spot")).alias("spots"))


def _kept(text: str | None, spots: list | None) -> tuple[list[bytes], int]:
    """Words left after removal, and the number of all words."""
    tokens = (text or "").encode().split()
    if not spots:
        return tokens, len(tokens)
    edge = np.zeros(len(tokens) + 1, np.int32)
    for spot in spots:
        start = spot >> 31
        edge[start] += 1
        edge[min(len(tokens), start + (spot & 0x7FFFFFFF) + WINDOW - 1)] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [t for t, k in zip(tokens, keep) if k], len(tokens)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = TABLE_BITS) -> DataFrame:
    """``id_col``, ``text`` (kept words joined by one space), ``n_words``, ``n_removed``, ``spans``: one row per row of ``docs``."""
    found = repeats(docs, id_col, text, bits)
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), (F.xxhash64(body).bitwiseAND(F.lit(0xFFFFFFFF))).alias("tag"),
        F.col(text).alias("text"), F.col(id_col).cast("long").alias("_own"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, words, removed = [], [], []
            for t, s in zip(batch.column(1), batch.column(2)):
                left, n = _kept(t.as_py(), s.as_py())
                out.append(b" ".join(left).decode())
                words.append(n)
                removed.append(n - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), batch.column(2)],
                names=["id", "text", "n_words", "n_removed", "spots"],
            )

    joined = keyed.join(found, ["id", "tag"], "left").select(F.col("_own").alias("id"), "text", "spots")
    done = joined.mapInArrow(run, "id bigint, text string, n_words bigint, n_removed bigint, spots array<bigint>")
    spans = F.transform("spots", lambda x: F.struct(
        F.shiftright(x, 31).alias("start"), x.bitwiseAND(F.lit(0x7FFFFFFF)).alias("starts")
    ))
    return done.select(F.col("id").alias(id_col), F.col("text").alias(text), "n_words", "n_removed", spans.alias("spans"))
