"""Alignment of two tokenizers over the same bytes, by pointer jumping, and corpus-wide counts of linked tokens.

A text is encoded by a byte-level BPE (A) and by a sentencepiece model (B). Every
token of a batch of texts points to the farthest-right token of the other side
that overlaps it, or, at the end of a group, A's token to itself. Replacing each
pointer by its target's pointer doubles the reach, so after a few vectorised
rounds every token points to the last A token of its group, which labels the
group. Groups are thus cut where tokens of both sides end.

Where no token of either side can reach across a single space between two words
(A's pattern starts a piece there; B is checked when its model is loaded), a text
is a row of words, each a whole number of groups. A worker then aligns each
distinct word once and puts texts together from what it remembers. Any other
text is one such word itself.

Counts: an id pair counts once per document that links it. Documents are counted
in blocks of ``BLOCK`` rows: a block's distinct pairs are one row each, however
often they are linked, so the exchange by pair never sees a pair more than once
per block, and the same rows carry the corpus-wide count back to the block.
Only A ids (never more than the vocabulary has) come by broadcast.

Defined results: NULL and empty texts, and texts which a side does not give back
byte for byte (a model may normalise them), have no tokens: counts of zero, no
groups, the empty string in place of a digest. Strings of special tokens are
plain text. Texts are encoded whole; repeated rows and NULL ids stand for
themselves; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from moodlake.llm.bpe import Store
from moodlake.llm.common import per_worker, scratch_table

# Rows counted together; a power of two.
BLOCK = 2048
# Bytes of text handled at once, unless one text has more.
STEP = 1 << 21
# Words, and characters in them, that a worker remembers; beyond this it starts afresh.
CACHED_WORDS, CACHED_CHARS = 400_000, 1 << 25
# A space that touches other white space: the words beside it are not told apart.
NEAR_SPACE = re.compile(r" (?:\s|$|(?<=\s )|(?<=^ ))")
# Words encoded in one call.
TOGETHER = 1000
# What sentencepiece writes for a space.
SPACE = "\u2581"
SEPARATORS = (b",", b"|", b";", b"")


def byte_of() -> dict[str, int]:
    """What each character of a byte-level vocabulary stands for: printable bytes for themselves, the others numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both vocabularies: encoders, and the bytes of every id."""

    def __init__(self, left: str, right: str, pattern: str) -> None:
        with open(left, encoding="utf-8") as file:
            model = json.load(file)["model"]
        stands, vocab = byte_of(), model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        tokens = [*sorted(stands, key=vocab.__getitem__), *map("".join, merges)]
        # Ids in merge order are ranks, so the BPE loop of tiktoken gives the same ids (tests compare both libraries).
        if [vocab[t] for t in tokens] != list(range(len(tokens))):
            raise ValueError(f"{left}: ids are not in the order of merges")
        left_bytes = [bytes(map(stands.__getitem__, t)) for t in tokens]
        self.left = tiktoken.Encoding("left", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(left_bytes)}, special_tokens={})
        self.right = sentencepiece.SentencePieceProcessor(model_file=right)
        pieces = [self.right.id_to_piece(i) for i in range(self.right.get_piece_size())]
        self.right_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.right.is_byte(i) else piece.replace(SPACE, " ").encode() for i, piece in enumerate(pieces)
        ]
        self.left_size, self.right_size = [np.array([len(b) for b in side], np.int64) for side in (left_bytes, self.right_bytes)]
        # Decimal ids with what follows them: one table for both sides, ``wide`` entries per separator.
        self.wide = max(len(left_bytes), len(pieces))
        self.decimal = [b"%d%s" % (i, s) for s in SEPARATORS for i in range(self.wide)]
        # Nothing is normalised, and no piece holds a space after another character.
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.right.serialized_model_proto())
        self.by_word = (
            spec.normalizer_spec.name == "identity" and spec.normalizer_spec.add_dummy_prefix
            and not spec.trainer_spec.treat_whitespace_as_suffix and not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        )

    def words(self, text: str) -> list[str]:
        """The parts of a text that no token leaves; each stands for itself after a space."""
        return text.split(" ") if self.by_word and SPACE not in text and not NEAR_SPACE.search(text) else [text]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, word after word, and how many each word has; none where the right side does not give the bytes back.

        Words are encoded together, as a text of them, where that is a text of just these words.
        """
        parts = []
        for i in range(0, len(words), TOGETHER):
            some = words[i:i + TOGETHER]
            if not self.by_word or any(" " in w or SPACE in w for w in some) or (found := self._joined(some)) is None:
                parts += [self._joined([w]) or (_NONE, _ZERO, _NONE, _ZERO) for w in some]
            else:
                parts.append(found)
        a, n_a, b, n_b = [np.concatenate([_NONE, *side]) for side in zip(*parts)]
        return a, n_a, b, n_b

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """``encode`` of words in one call; None if the right side does not give them back. The left side is bytes and always does."""
        text = " ".join(words)
        b = self.right.encode(text)
        if b"".join(map(self.right_bytes.__getitem__, b)) != b" " + text.encode():
            return None
        left, right = np.array(self.left.encode_ordinary(" " + text), np.int64), np.array(b, np.int64)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        counts = [
            np.diff(np.searchsorted(np.cumsum(size[ids]), ends, "right"), prepend=0)
            for ids, size in ((left, self.left_size), (right, self.right_size))
        ]
        return left, counts[0], right, counts[1]


_NONE, _ZERO = np.empty(0, np.int64), np.zeros(1, np.int64)


def terminals(succ: np.ndarray) -> np.ndarray:
    """Where each pointer chain ends: pointers are doubled until none changes."""
    while not np.array_equal(further := succ[succ], succ):
        succ = further
    return succ


class Aligned:
    """Groups and links of some words, their tokens laid one word after another."""

    def __init__(self, p: Pair, words: list[str]) -> None:
        self.a, self.n_a, self.b, self.n_b = p.encode(words)
        a_end, b_end = np.cumsum(p.left_size[self.a]), np.cumsum(p.right_size[self.b])
        a_start = a_end - p.left_size[self.a]
        na = len(self.a)
        # How many tokens of a side end at or before each byte offset.
        n_bytes = int(a_end[-1]) if na else 0
        ended_a, ended_b = [np.cumsum(np.bincount(end, minlength=n_bytes + 1)) for end in (a_end, b_end)]
        first, last = ended_b[a_start], ended_b[a_end - 1]
        end = terminals(np.concatenate([np.where(b_end[last] > a_end, na + last, np.arange(na)), ended_a[b_end - 1]]))
        cuts = np.flatnonzero(end[:na] == np.arange(na))
        number = np.zeros(na, np.int64)
        number[cuts] = np.arange(len(cuts))
        self.group_a, self.group_b = number[end[:na]], number[end[na:]]
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=len(cuts)), np.bincount(self.group_b, minlength=len(cuts))
        # Groups never span words, as both sides end where a word ends.
        owner = np.repeat(np.arange(len(words)), self.n_a)
        self.n_groups = np.bincount(owner[cuts], minlength=len(words))
        per_a = last - first + 1
        ends = np.cumsum(per_a)
        self.link_a = np.repeat(np.arange(na), per_a)
        self.link_b = np.arange(ends[-1] if na else 0) + np.repeat(first - (ends - per_a), per_a)
        self.n_links = np.bincount(owner[self.link_a], minlength=len(words))

    def spelled(self, p: Pair) -> list[bytes]:
        """Each word's groups as ``a1,a2|b1;a3|b2``."""
        na, nb = len(self.a), len(self.b)
        before_b, upto_a = np.cumsum(self.size_b) - self.size_b, np.cumsum(self.size_a)
        more_a, more_b = [np.append(g[1:] == g[:-1], False)[:len(g)] for g in (self.group_a, self.group_b)]
        after_b = np.where(more_b, 0, 2)
        after_b[np.cumsum(self.n_b)[self.n_b > 0] - 1] = 3
        coded = np.empty(na + nb, np.int64)
        coded[np.arange(na) + before_b[self.group_a]] = self.a + np.where(more_a, 0, 1) * p.wide
        coded[np.arange(nb) + upto_a[self.group_b]] = self.b + after_b * p.wide
        parts, at, out = list(map(p.decimal.__getitem__, coded.tolist())), 0, []
        for n in (self.n_a + self.n_b).tolist():
            out.append(b"".join(parts[at:at + n]))
            at += n
        return out


class Memory:
    """What is known of the words a worker has seen."""

    def __init__(self, p: Pair) -> None:
        self.pair = p
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.counts = np.empty((0, 4), np.int64)
        self.spelled: list[bytes] = []
        # a, b, how many of each per group, and linked id pairs (A id x ``right size`` + B id).
        self.stores = {name: Store(np.int64) for name in ("a", "b", "group_a", "group_b", "pairs")}

    def learn(self, words: list[str]) -> None:
        found = Aligned(self.pair, words)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.chars += sum(map(len, words))
        self.counts = np.concatenate([self.counts, np.column_stack([found.n_a, found.n_b, found.n_groups, found.n_links])])
        self.spelled += found.spelled(self.pair)
        linked = found.a[found.link_a] * len(self.pair.right_bytes) + found.b[found.link_b]
        for name, flat, sizes in (
            ("a", found.a, found.n_a), ("b", found.b, found.n_b), ("group_a", found.size_a, found.n_groups),
            ("group_b", found.size_b, found.n_groups), ("pairs", linked, found.n_links),
        ):
            self.stores[name].add(flat, sizes)

    def look(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' words one text after another, and how many each has: none for a text without tokens."""
        words = [self.pair.words(t) if t else [] for t in texts]
        new = set(chain.from_iterable(words)) - self.known.keys()
        if len(self.known) + len(new) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.forget()
            new = set(chain.from_iterable(words))
        if new:
            self.learn(list(new))
        n = np.fromiter(map(len, words), np.int64, len(words))
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, int(n.sum()))
        # A word that the right side does not give back takes its whole text with it.
        bad = by_text((self.counts[numbers, 0] == 0).astype(np.int64), n) > 0
        return numbers[~np.repeat(bad, n)], np.where(bad, 0, n)

    def lists(self, name: str, numbers: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the texts' words one after another, and how many each text has."""
        flat, sizes = self.stores[name].gather(numbers)
        return flat, by_text(sizes, n)

    def pairs(self, numbers: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text its distinct id pairs, ascending: the pairs, their links, and how many each text has."""
        flat, sizes = self.lists("pairs", numbers, n)
        found, times = np.unique(np.repeat(np.arange(len(n)), sizes) << 40 | flat, return_counts=True)
        return found & ((1 << 40) - 1), times, np.bincount(found >> 40, minlength=len(n))

    def digests(self, numbers: np.ndarray, n: np.ndarray) -> list[str]:
        """SHA-256 of each text's groups; the empty string for a text without tokens."""
        parts, at, out = list(map(self.spelled.__getitem__, numbers.tolist())), 0, []
        for k in n.tolist():
            out.append(hashlib.sha256(b";".join(parts[at:at + k])).hexdigest() if k else "")
            at += k
        return out


def by_text(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums over each run of ``n`` values."""
    upto = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    ends = np.cumsum(n)
    return upto[ends] - upto[ends - n]


def memory(left: str, right: str, pattern: str) -> Memory:
    return per_worker("alignment", (left, right, pattern), lambda: Memory(Pair(left, right, pattern)))


def _steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most STEP bytes of text together, or one row."""
    first, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if i > first and held + (size or 0) > STEP:
            yield first, i
            first, held = i, 0
        held += size or 0
    if first < len(texts):
        yield first, len(texts)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def align(docs: DataFrame, left: str, right: str, pattern: str, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the struct ``row`` with its columns, the ids ``a`` and ``b``, and how many of
    each belong to each group in turn (``group_a``, ``group_b``)."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("body"))
    names = ("a", "b", "group_a", "group_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memory(left, right, pattern)
        for batch in batches:
            for i, j in _steps(batch.column("body")):
                numbers, n = known.look(batch.column("body").slice(i, j - i).to_pylist())
                lists = [_lists(flat.astype(np.int32), sizes) for flat, sizes in (known.lists(k, numbers, n) for k in names)]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), *lists], names=["row", *names])

    schema = packed.select("row").schema
    for name in names:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    return packed.mapInArrow(run, schema)


def _measured(docs: DataFrame, id_col: str, text: str, left: str, right: str, pattern: str) -> DataFrame:
    """Per row: its id, counts, the groups' digest, its distinct pairs and the links of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memory(left, right, pattern)
        for batch in batches:
            for i, j in _steps(batch.column("body")):
                numbers, n = known.look(batch.column("body").slice(i, j - i).to_pylist())
                counts = by_text(known.counts[numbers], n)
                keys, times, sizes = known.pairs(numbers, n)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(i, j - i), *map(pa.array, counts.T), pa.array(known.digests(numbers, n)),
                    _lists(keys, sizes), _lists(times.astype(np.int32), sizes),
                ], names=[f.name for f in schema.fields])

    body = docs.select(F.col(id_col).alias("id"), F.col(text).alias("body"))
    schema = body.select("id").schema
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.IntegerType()))
    return body.mapInArrow(run, schema)


def _block_pairs(rows: DataFrame) -> DataFrame:
    """``block``, ``pair``, ``n``: the distinct pairs of each block and how many of its rows link them.

    A block that two tasks read gives a pair twice; sums are not affected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), at)), pa.array(keys), pa.array(n)], names=["block", "pair", "n"])

        for batch in batches:
            blocks, lists = batch.column("block").to_numpy(), batch.column("pairs")
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                if blocks[i] != at:
                    yield from done()
                    at, held = blocks[i], []
                held.append(lists.slice(i, j - i).flatten().to_numpy())
        yield from done()

    return rows.select("block", "pairs").mapInArrow(run, "block bigint, pair bigint, n bigint")


def _answered(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of one block with sums over their links, from the block's pairs and their corpus-wide counts."""
    keys, first = np.unique(answers.column("pair").to_numpy(), return_index=True)
    counts, best = answers.column("count").to_numpy()[first], answers.column("best").to_numpy()[first]
    pairs, times = rows.column("pairs").combine_chunks(), rows.column("times").combine_chunks()
    flat, weight = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(keys, flat)
    owner = np.repeat(np.arange(len(rows)), pc.list_value_length(pairs).to_numpy())
    sums = np.zeros(len(rows), np.int64)
    bests = np.zeros(len(rows), np.int64)
    if len(flat):
        np.add.at(sums, owner, weight * counts[at])
        np.add.at(bests, owner, weight * (counts[at] == best[at]))
    return rows.drop_columns(["pairs", "times", "block"]).append_column("n_best", pa.array(bests)).append_column("count_sum", pa.array(sums))


def link_counts(
    docs: DataFrame, left: str, right: str, pattern: str, id_col: str = "doc_id", text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, and over its
    links ``n_best`` (links whose count is the highest of their A id) and ``count_sum``."""
    measured = _measured(docs, id_col, text, left, right, pattern)
    # Written once with its place, so that blocks are the same whenever they are read.
    rows = scratch_table(measured.withColumn("place", F.monotonically_increasing_id()), "aligned")
    rows = rows.withColumn("block", F.expr(f"place div {block}")).drop("place")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = _block_pairs(rows).repartition(tasks, "pair")
    width = sentencepiece.SentencePieceProcessor(model_file=right).get_piece_size()
    counts = met.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.expr(f"pair div {width}"))
    # At most one row per A id, so the vocabulary bounds what is broadcast.
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    counts = counts.join(F.broadcast(best), "a").select("pair", "count", "best")
    answers = met.select("block", "pair").join(counts, "pair").select("block", "pair", "count", "best")
    schema = rows.drop("block", "pairs", "times").schema.add("n_best", "long").add("count_sum", "long")
    done = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answered, schema)
    return done.withColumnRenamed("id", id_col)
