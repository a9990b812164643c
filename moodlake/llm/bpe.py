"""Byte-level BPE with the ranks of a public vocabulary: pieces in the JVM, merges in DuckDB, ids in numpy.

Spark splits each text with the vocabulary's pattern and deals the work out.
Inside a task the distinct pieces of a batch go through one recursive DuckDB
query: the piece's bytes are token-position rows, the rows join the merge
table, and each piece contracts its leftmost pair of the lowest rank until no
pair is left. Decoding joins token-position rows with the vocabulary and
concatenates in order of position. A bounded cache per worker keeps pieces
already seen, so that the query's work grows with new pieces and not with text.

A piece of more than ``LONG_PIECE`` bytes (an unbroken run of letters, say) is
contracted with a heap over the same merge table: the recursive query takes one
pass per contraction, which is quadratic for such a run.

Defined results: NULL and empty texts have no tokens and decode to nothing;
repeated rows are each encoded; other columns pass through; an empty table
gives an empty result. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import per_worker

LONG_PIECE = 256
# Pieces a worker remembers; beyond this it starts afresh. About 150 bytes each.
CACHED_PIECES = 400_000
# Pieces handled at once, unless one text has more.
STEP = 200_000
# The recursive query keeps every state of a piece: at most as many token positions as half the square of its bytes. So many
# (or one piece) go into one query, which bounds its memory; DuckDB needs no folder to spill to.
POSITIONS = 1 << 21

ENCODE_SQL = """
WITH RECURSIVE state(w, toks) AS (
  SELECT w, toks FROM pieces
  UNION ALL
  SELECT s.w, s.toks[:b.p - 1] || [b.r] || s.toks[b.p + 2:]
  FROM state s JOIN (
    SELECT w, best & 4294967295 AS p, best >> 32 AS r
    FROM (
      SELECT w, min((m.r << 32) | p) AS best
      FROM (
        SELECT w, unnest(toks[:-2]) AS a, unnest(toks[2:]) AS b, generate_subscripts(toks[2:], 1) AS p
        FROM state WHERE len(toks) > 1
      ) JOIN merges m ON m.ab = (a << 20) | b
      GROUP BY w
    )
  ) b USING (w)
)
SELECT w, arg_min(toks, len(toks)) AS toks FROM state GROUP BY w ORDER BY w
"""
DECODE_SQL = """
SELECT w, unhex(string_agg(hex, '' ORDER BY p)) AS bytes
FROM (SELECT w, unnest(toks) AS tok, generate_subscripts(toks, 1) AS p FROM pieces) JOIN vocabulary USING (tok)
GROUP BY w ORDER BY w
"""


class Store:
    """Variable-length values side by side in one array, found by number."""

    def __init__(self, kind: type) -> None:
        self.flat, self.start, self.size = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of these numbers one after another, and their sizes."""
        sizes = self.size[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at], sizes


class Codec:
    """One vocabulary with its merge table and the pieces seen so far."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.token = dict(zip(self.ranks.values(), self.ranks))
        # Two tokens merge if their bytes together are a token; its rank is the pair's rank.
        merges = np.array([
            ((left << 20) | right, rank)
            for token, rank in self.ranks.items() for i in range(1, len(token))
            if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None
        ], np.int64).reshape(-1, 2)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.con.register("m", pa.table({"ab": merges[:, 0], "r": merges[:, 1]}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM m")
        self.con.register("v", pa.table({"tok": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM v")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = Store(np.uint32)
        self.back = Store(np.uint8)
        self.spelled: dict[bytes, int] = {}
        self.text = Store(np.uint8)

    def _ask(self, sql: str, pieces: list[np.ndarray]) -> pa.Table:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        toks = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(pieces).astype(np.int64)))
        table = pa.table({"w": np.arange(len(pieces)), "toks": toks})
        self.con.register("pieces", table)
        result = self.con.sql(sql).to_arrow_table()
        self.con.unregister("pieces")
        return result

    def pair(self, left: int, right: int) -> int | None:
        """The rank of two tokens that merge."""
        return self.ranks.get(self.token[left] + self.token[right])

    def contract(self, piece: bytes) -> list[int]:
        """Contract one long piece: the same rule with a heap instead of passes."""
        toks = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(toks) + 1)), list(range(-1, len(toks) - 1))
        heap = [(r, i, toks[i], toks[i + 1]) for i in range(len(toks) - 1) if (r := self.pair(toks[i], toks[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if toks[i] != left or j >= len(toks) or toks[j] != right:
                continue
            toks[i], toks[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(toks):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(toks) and (r := self.pair(toks[a], toks[b])) is not None:
                    heapq.heappush(heap, (r, a, toks[a], toks[b]))
        return [t for t in toks if t >= 0]

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and the number of ids of each piece."""
        numbers = self.numbers(pieces)  # may begin the stores anew
        return self.ids.gather(numbers)

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The pieces' numbers in the stores: ``ids`` gives their ids, ``decoded`` what these decode to."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > CACHED_PIECES:
            self.forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            raw = [w.encode() for w in new]
            short = [i for i, b in enumerate(raw) if len(b) <= LONG_PIECE]
            found: list[np.ndarray] = [np.empty(0, np.int64)] * len(new)
            upto = np.cumsum([len(raw[i]) ** 2 // 2 for i in short])
            for some in np.split(np.array(short, np.int64), np.flatnonzero(np.diff(upto // POSITIONS)) + 1):
                if not len(some):
                    continue
                toks = self._ask(ENCODE_SQL, [self.bytes[np.frombuffer(raw[i], np.uint8)] for i in some])
                lists = toks["toks"].combine_chunks()
                flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                for k, i in enumerate(some):
                    found[i] = flat[ends[k]:ends[k + 1]]
            for i, b in enumerate(raw):
                if len(b) > LONG_PIECE:
                    found[i] = np.array(self.contract(b), np.int64)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.ids.add(np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found)))
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return numbers[coded.indices.to_numpy()]

    def decoded(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the ids of encoded pieces decode to, one after another, and the number of bytes of each piece."""
        for first in range(len(self.back.size), len(self.ids.size), STEP):
            new = np.arange(first, min(first + STEP, len(self.ids.size)))
            flat, sizes = self.ids.gather(new)
            runs = np.split(flat, np.cumsum(sizes)[:-1])
            spelled = self._ask(DECODE_SQL, runs)["bytes"].to_pylist()
            self.back.add(np.frombuffer(b"".join(spelled), np.uint8), np.fromiter(map(len, spelled), np.int64, len(spelled)))
        return self.back.gather(numbers)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of runs of ids of these sizes one after another, and the number of bytes of each run."""
        ids = np.ascontiguousarray(ids, np.uint32)
        offsets = np.concatenate([[0], np.cumsum(sizes) * 4]).astype(np.int64)
        runs = pa.Array.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
        )
        coded = runs.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.spelled) + len(distinct) > CACHED_PIECES:
            self.spelled, self.text = {}, Store(np.uint8)
        new = [r for r in distinct if r not in self.spelled]
        if new:
            filled = [r for r in new if r]
            spelled = dict.fromkeys(new, b"")
            if filled:
                spelled.update(zip(filled, self._ask(DECODE_SQL, [np.frombuffer(r, np.uint32) for r in filled])["bytes"].to_pylist()))
            self.spelled.update(zip(new, range(len(self.spelled), len(self.spelled) + len(new))))
            joined = np.frombuffer(b"".join(spelled.values()), np.uint8)
            self.text.add(joined, np.fromiter(map(len, spelled.values()), np.int64, len(spelled)))
        numbers = np.fromiter(map(self.spelled.__getitem__, distinct), np.int64, len(distinct))
        return self.text.gather(numbers[coded.indices.to_numpy()])


def codec(path: str, pattern: str) -> Codec:
    return per_worker("codec", (path, pattern), lambda: Codec(path, pattern))


def _by_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values up to each of the ends."""
    return np.concatenate([[0], np.cumsum(values)])[ends]


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch into rows with at most STEP pieces together, or one row."""
    sizes = np.diff(batch.column("_pieces").offsets.to_numpy())
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > STEP:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if len(sizes) > first:
        yield batch.slice(first)


def _encoded(c: Codec, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pieces, and the pieces' ends per row of a batch."""
    pieces = batch.column("_pieces")
    odd = batch.column("_odd")
    if odd.null_count < len(odd):
        rows = [p if o is None else c.pattern.findall(o) for p, o in zip(pieces.to_pylist(), odd.to_pylist())]
        pieces = pa.array(rows, pa.list_(pa.string()))
    ends = pieces.offsets.to_numpy().astype(np.int64)
    return c.numbers(pieces.flatten()), ends - ends[0]


def _pieces(docs: DataFrame, pattern: str, text: str, keep: list[str]) -> DataFrame:
    """The kept columns as one struct ``_row``, and texts split in the JVM. Characters newer than the JVM's tables go to the
    workers' own splitter."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    odd = body.rlike(r"\p{Cn}")
    found = F.regexp_extract_all(body, F.lit("(?U)" + pattern), F.lit(0))
    row = F.struct(*[F.col(f"`{c}`") for c in keep], *[] if keep else [F.lit(0).alias("none")])
    return docs.select(
        row.alias("_row"), F.when(odd, F.array().cast("array<string>")).otherwise(found).alias("_pieces"), F.when(odd, body).alias("_odd")
    )


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` and ``piece_sizes`` (number of ids of each piece of the pattern); input columns of these names give way."""
    schema = T.StructType([
        *[f for f in docs.schema.fields if f.name not in ("ids", "piece_sizes")],
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("piece_sizes", T.ArrayType(T.IntegerType())),
    ])
    keep = [f.name for f in schema.fields[:-2]]
    split = _pieces(docs, pattern, text, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for part in _steps(batch):
                numbers, ends = _encoded(c, part)
                ids, sizes = c.ids.gather(numbers)
                at = _by_row(sizes, ends).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))
                counts = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(sizes.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(part.column("_row").flatten()[:len(keep)] + [lists, counts], names=[*keep, "ids", "piece_sizes"])

    return split.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", sizes: str | None = "piece_sizes") -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``; with the sizes of pieces given, each distinct piece is decoded once."""
    schema = T.StructType([*[f for f in encoded.schema.fields if f.name != "decoded"], T.StructField("decoded", T.BinaryType())])
    keep = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            rows = [x if x is not None else [] for x in batch.column(ids).to_pylist()]
            runs = [x if x is not None else [] for x in batch.column(sizes).to_pylist()] if sizes else [[len(r)] for r in rows]
            flat = np.array([i for r in rows for i in r], np.uint32)
            text, n = c.decode(flat, np.array([i for r in runs for i in r], np.int64))
            at = _by_row(n, np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int64))
            whole = text.tobytes()
            out = pa.array([whole[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [out], names=[*keep, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass; the text, and input columns of these names, give way to ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256``."""
    keep = [c for c in docs.columns if c not in (text, "n_tokens", "ids_sha256", "decoded_sha256")]
    split = _pieces(docs, pattern, text, keep)
    schema = T.StructType([
        *[docs.schema[c] for c in keep], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for part in _steps(batch):
                numbers, ends = _encoded(c, part)
                (ids, sizes), (text_bytes, n) = c.ids.gather(numbers), c.decoded(numbers)
                at, spots = _by_row(sizes, ends), _by_row(n, ends)
                columns = [
                    pa.array(np.diff(at)),
                    pa.array(_digests(ids.astype("<u4"), at)),
                    pa.array(_digests(text_bytes, spots)),
                ]
                yield pa.RecordBatch.from_arrays(part.column("_row").flatten()[:len(keep)] + columns, names=[f.name for f in schema.fields])

    return split.mapInArrow(run, schema)


def _digests(values: np.ndarray, ends: np.ndarray, of: Callable = hashlib.sha256) -> list[str]:
    return [of(values[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
