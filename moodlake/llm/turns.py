"""Repair of conversation structure by a shortest-path DP with checkpoints.

A repaired conversation's role initials are ``(s?(ua)+)?``. Edits: Keep a row
(0), Rerole it to user or assistant (1), Delete it (2, required for a blank or
repeated row), Insert an empty row (5); a truncated row that stays adds 5. Among
the cheapest edits those with the ASCII-least initials are chosen.

A DP state is the place in that pattern; four costs, one per state, say what the
rows from here to the end still cost. They are computed backward and stored only
at checkpoints; walking forward, the rows between two checkpoints are computed
again and the least tight edit of each row is emitted. This is done twice over:

- Conversations are cut into blocks of rows, so that one of any length is many
  tasks. A block gives its min-plus matrix (state before to state after); the
  matrices, a few numbers each, are folded backward along the conversation and
  leave each block its checkpoint, the costs at its end.
- Within a block of n rows a vector is kept every sqrt(n) rows. As the walk of
  the earlier blocks is not known yet, it is made from each of the four states;
  folding forward picks the right one.

A row is one byte for all this (role initial and fault). Its text moves twice:
into order, and to the place where edits are applied.

Defined results: rows are ordered by turn (NULL first), then role, then a hash
of the text; rows equal in all of these are repeats, whose first one stays. A
NULL role, text or turn is a value like any other (a NULL text is blank, a NULL
role has no initial). A NULL conversation id is one conversation. An empty table
gives an empty result. Columns of the input are carried in one struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import islice
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from moodlake.llm.common import join_hot, scratch_table

WHITE = " \t\n\x0b\x0c\r"
# Rows of one conversation that a task repairs at once: two to this power.
BLOCK_BITS = 12
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# States: nothing yet, after system, after user, after assistant. A row's initial: s, u, a or another.
INITIALS = "sua"
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
# The state after a user or assistant row where one may stand, and that role.
ADDED = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
# Costs after the last row: only what inserts can still complete.
END = (0.0, 2.0 * INSERT, 1.0 * INSERT, 0.0)
# Neighbouring initials that may stand: su, ua, au.
LEGAL = {(0, 1), (1, 2), (2, 1)}
AT_ONCE = 1000
_NOTHING = object()
Costs = tuple[float, ...]
Batches = Iterator[pa.RecordBatch]


class Steps:
    """One row's part of the DP, remembered by row code and costs after it (which are few, being relative)."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, Costs], tuple[Costs, float, tuple]] = {}

    def __call__(self, code: int, after: Costs) -> tuple[Costs, float, tuple]:
        """Costs before the row, less the smallest of them; that one; per state the letters up to the row's own and the state after it."""
        key = (code, after)
        if key not in self.known:
            self.known[key] = self._made(code, after)
        return self.known[key]

    @staticmethod
    def _made(code: int, after: Costs) -> tuple[Costs, float, tuple]:
        fault, initial = divmod(code, 4)
        stays = fault not in (1, 2)
        extra = TRUNCATED if fault == 3 else 0
        ways = []
        for state in range(4):
            to = [("D", DELETE + after[state], state)]
            if stays and initial in KEPT[state]:
                to.append(("K", extra + after[KEPT[state][initial]], KEPT[state][initial]))
            if stays:
                to.append(("R", REROLE + extra + after[ADDED[state]], ADDED[state]))
            ways.append(to)
        direct = [min(cost for _, cost, _ in to) for to in ways]
        # At most two inserts help before a row: users and assistants alternate.
        best = [min(direct[s], INSERT + direct[ADDED[s]], 2 * INSERT + direct[ADDED[ADDED[s]]]) for s in range(4)]
        moves = []
        for at in range(4):
            letters, state = "", at
            while True:
                tight = [(letter, to) for letter, cost, to in ways[state] if cost == best[state] < inf]
                if INSERT + best[ADDED[state]] == best[state] < inf:
                    tight.append(("I", ADDED[state]))
                if not tight:
                    break
                letter, state = min(tight)
                letters += letter
                if letter != "I":
                    break
            moves.append((letters, state))
        least = min(best)
        return tuple(b - least for b in best), least, tuple(moves)


def matrix(codes: bytes, step: Steps) -> list[float]:
    """Cost from each state before the rows to each state after them, 16 numbers."""
    columns = []
    for to in range(4):
        costs, total = tuple(0.0 if s == to else inf for s in range(4)), 0.0
        for code in reversed(codes):
            costs, more, _ = step(code, costs)
            total += more
        columns.append([c + total for c in costs])
    return [columns[to][s] for s in range(4) for to in range(4)]


def before(through: list[float], after: Costs) -> Costs:
    return tuple(min(through[4 * s + to] + after[to] for to in range(4)) for s in range(4))


def relative(costs: Costs) -> Costs:
    least = min(costs)
    return tuple(c - least for c in costs)


def walks(codes: bytes, end: Costs, step: Steps) -> list[tuple[str, int]]:
    """From each state: the letters of the least tight edits of the rows, and the state after them.

    Backward costs are stored every sqrt(n) rows and computed again block by block on the way forward.
    """
    width = max(1, isqrt(len(codes)))
    kept, costs = {}, end
    for i in range(len(codes), 0, -1):
        if i % width == 0 or i == len(codes):
            kept[i] = costs
        costs = step(codes[i - 1], costs)[0]
    states, letters = [0, 1, 2, 3], [[], [], [], []]
    for first in range(0, len(codes), width):
        last = min(first + width, len(codes))
        moves, costs = [], kept[last]
        for i in range(last, first, -1):
            costs, _, move = step(codes[i - 1], costs)
            moves.append(move)
        for move in reversed(moves):
            for k in range(4):
                added, states[k] = move[states[k]]
                letters[k].append(added)
    return [("".join(parts), state) for parts, state in zip(letters, states)]


def _stream(df: DataFrame, names: list[str], schema: T.StructType, fold: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """Rows of each partition in order through ``fold``, a generator over tuples of ``names``."""

    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Batches) -> Batches:
        rows = fold(row for batch in batches for row in zip(*[batch.column(n).to_pylist() for n in names]))
        while held := list(islice(rows, AT_ONCE)):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*held), kinds)], names=schema.fieldNames())

    return df.select(*names).mapInArrow(run, schema)


def ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order, written once: ``conv``, ``turn``, ``role``, ``text``, ``row`` and ``pos``, which follows that order.

    The last sort key tells equal rows apart, so that no group of them is one task.
    """
    def own(name: str) -> Column:
        return F.col(f"`{name}`")

    packed = rows.select(
        own(conv).alias("conv"), own(turn).cast("long").alias("turn"),
        F.struct(*[own(c) for c in rows.columns if c != text]).alias("row"), own(role).alias("role"), own(text).alias("text"),
    )
    packed = packed.withColumn("hash", F.xxhash64("text")).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ("conv", "turn", "role", "hash", "salt")
    placed = packed.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    return scratch_table(placed.drop("hash", "salt"), "turns")


def coded(placed: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``pos`` and ``code`` (initial + 4 x first fault) of each row."""
    trimmed = F.rtrim(F.coalesce("text", F.lit("")), F.lit(WHITE))
    initial = F.substring(F.coalesce("role", F.lit("")), 1, 1)
    number = F.coalesce(*[F.when(initial == c, F.lit(i)) for i, c in enumerate(INITIALS)], F.lit(3))
    lean = placed.select(
        "conv", "turn", "pos", number.alias("initial"), (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        # Of a row with text: a digest that rows equal in conversation, role and text share.
        F.when(trimmed != "", F.md5(F.to_json(F.struct("conv", "role", "text")).cast("binary"))).alias("same"),
    )
    repeats = lean.filter("same IS NOT NULL").groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")).filter("n > 1")
    marked = join_hot(lean, scratch_table(repeats, "repeats"), "same", "n")
    fault = F.when(F.col("blank"), 1).when(F.col("first") < F.col("pos"), 2).when(F.col("cut"), 3).otherwise(0)
    return marked.select("conv", "turn", "pos", (F.col("initial") + 4 * fault).alias("code"))


def _blocks(codes: DataFrame, conv: T.StructField) -> DataFrame:
    """One row per block: its codes, matrix, counts of faults, and what joins it to its neighbours."""

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        step, at, held, turns = Steps(), None, bytearray(), []

        def done() -> tuple:
            found = bytes(held)
            faults = [sum(c >> 2 == f for c in found) for f in (1, 2, 3)]
            illegal = sum((a & 3, b & 3) not in LEGAL for a, b in zip(found, found[1:]))
            numbers = [t for t in turns if t is not None]
            ends = (numbers[0], numbers[-1]) if numbers else (None, None)
            return (*at, found, matrix(found, step), *faults, illegal, *ends, len(set(numbers)))

        for conv, chunk, turn, code in rows:
            if (conv, chunk) != at:
                if at is not None:
                    yield done()
                at, held, turns = (conv, chunk), bytearray(), []
            held.append(code)
            turns.append(turn)
        if at is not None:
            yield done()

    schema = T.StructType([conv, *_fields(
        chunk="bigint", codes="binary", matrix="array<double>", blank="bigint", duplicate="bigint", truncated="bigint",
        illegal="bigint", first_turn="bigint", last_turn="bigint", turns="bigint",
    )])
    placed = codes.withColumn("chunk", F.shiftright("pos", BLOCK_BITS)).repartition(*_tasks(codes), "conv", "chunk")
    return _stream(placed.sortWithinPartitions("conv", "chunk", "pos"), ["conv", "chunk", "turn", "code"], schema, fold)


def _fields(**kinds: str) -> list[T.StructField]:
    return list(T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in kinds.items())).fields)


def _tasks(df: DataFrame) -> tuple[int]:
    return (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),)


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """The matrix gives way to ``end``, the costs after each block, and ``cost``, from the block on, folding matrices backward."""
    names = blocks.columns

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        at, costs = _NOTHING, END
        for row in rows:
            last = row[0] != at
            if last:
                at, costs = row[0], END
            earlier = before(row[3], costs)
            yield (*row[:3], list(relative(costs)), int(earlier[0]), last, *row[4:])
            costs = earlier

    kinds = {f.name: f for f in blocks.schema.fields}
    schema = T.StructType([*[kinds[c] for c in names[:3]], *_fields(end="array<double>", cost="bigint", last="boolean"), *[kinds[c] for c in names[4:]]])
    placed = blocks.repartition(*_tasks(blocks), "conv").sortWithinPartitions("conv", F.desc("chunk"))
    return _stream(placed, names, schema, fold)


def _walked(blocks: DataFrame) -> DataFrame:
    """``codes`` and ``end`` give way to the ``letters`` and the state ``after``, from each state before the block."""
    names = blocks.columns

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        step = Steps()
        for conv, chunk, codes, end, *rest in rows:
            found = walks(codes, tuple(end), step)
            yield (conv, chunk, [letters for letters, _ in found], [state for _, state in found], (codes[0] & 3) * 4 + (codes[-1] & 3), *rest)

    kinds = {f.name: f for f in blocks.schema.fields}
    schema = T.StructType([kinds["conv"], kinds["chunk"], *_fields(letters="array<string>", after="array<int>", sides="int"), *[kinds[c] for c in names[4:]]])
    return _stream(blocks.repartition(*_tasks(blocks), "conv", "chunk"), names, schema, fold)


def _chosen(blocks: DataFrame) -> DataFrame:
    """Per block the state ``before`` it and its ``letters``, folding forward; inserts after the last row included. A block's
    ``illegal`` and ``turns`` leave out what it shares with the block before."""
    names = blocks.columns

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        at, state, side, turn = _NOTHING, 0, None, None
        for conv, chunk, letters, after, sides, cost, last, blank, duplicate, truncated, illegal, first_turn, last_turn, turns in rows:
            if conv != at:
                at, state, side, turn = conv, 0, None, None
            if side is not None:
                illegal += (side, sides >> 2) not in LEGAL
            if first_turn is not None:
                turns -= first_turn == turn
                turn = last_turn
            added = "I" * int(END[after[state]] // INSERT) if last else ""
            yield conv, chunk, letters[state] + added, state, cost, blank, duplicate, truncated, illegal, first_turn, last_turn, turns
            state, side = after[state], sides & 3

    kinds = {f.name: f for f in blocks.schema.fields}
    schema = T.StructType([kinds["conv"], kinds["chunk"], *_fields(letters="string", before="int"), kinds["cost"], *[kinds[c] for c in names[7:]]])
    placed = blocks.repartition(*_tasks(blocks), "conv").sortWithinPartitions("conv", "chunk")
    return _stream(placed, names, schema, fold)


def plan(placed: DataFrame) -> DataFrame:
    """One row per block of ``ordered`` rows: its edits as ``letters``, the state ``before`` it, its counts and the cost from it on."""
    blocks = _blocks(coded(placed), placed.schema["conv"])
    return scratch_table(_chosen(_walked(_checkpoints(blocks))), "edits")


COUNTS = ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns", "cost")


def _applied(placed: DataFrame, edits: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """A block's edits followed by its rows, in order, dealt out by ``by``."""
    rows = placed.withColumn("chunk", F.shiftright("pos", BLOCK_BITS))
    both = edits.withColumn("pos", F.lit(-1).cast("long")).unionByName(rows, allowMissingColumns=True)
    return both.repartition(*_tasks(placed), *by).sortWithinPartitions("conv", "chunk", "pos")


class Walk:
    """Applies a block's letters to its rows, one by one."""

    def __init__(self, letters: str, state: int) -> None:
        self.left, self.state = iter(letters), state

    def edit(self, role: str | None) -> Iterator[tuple[str, str | None]]:
        """Letter and final role of the inserts before a row, then of the row."""
        for letter in self.left:
            if letter == "I" or letter == "R":
                self.state = ADDED[self.state]
                yield letter, ROLE[self.state]
            elif letter == "K":
                self.state = KEPT[self.state][INITIALS.index(role[0])]
                yield letter, role
            else:
                yield letter, None
            if letter != "I":
                return

    def rest(self) -> Iterator[tuple[str, str]]:
        """The inserts after the last row."""
        for letter in self.left:
            self.state = ADDED[self.state]
            yield letter, ROLE[self.state]


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every edit in order: ``conv``, ``place`` (ascending within a conversation), ``edit`` (D, I, K or R), the final ``role`` and
    ``text`` (NULL and empty for an insert's; a deleted row keeps its text and has no role) and the input ``row`` without its text."""
    placed = ordered(rows, conv, turn, role, text)
    both = _applied(placed, plan(placed), ("conv", "chunk"))

    def fold(items: Iterator[tuple]) -> Iterator[tuple]:
        walk, at, n = None, None, 0

        def rest() -> Iterator[tuple]:
            for k, (letter, name) in enumerate(walk.rest() if walk else ()):
                yield at[0], [at[1], n + k], letter, name, "", None

        for conv, chunk, pos, letters, state, name, body, row in items:
            if pos < 0:
                yield from rest()
                walk, at, n = Walk(letters, state), (conv, chunk), 0
                continue
            for letter, final in walk.edit(name):
                yield conv, [chunk, n], letter, final, "" if letter == "I" else body, None if letter == "I" else row
                n += 1
        yield from rest()

    schema = T.StructType([placed.schema["conv"], *_fields(place="array<bigint>", edit="string", role="string", text="string"), T.StructField("row", placed.schema["row"].dataType)])
    return _stream(both, ["conv", "chunk", "pos", "letters", "before", "role", "text", "row"], schema, fold)


def report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``gaps``, counts of faults, ``cost``, ``audit`` and ``repaired_sha256``.

    SHA-256 reads a conversation from its first row to its last, so here one task streams each conversation's rows; it holds
    the audit string and one row at a time.
    """
    placed = ordered(rows, conv, turn, role, text)
    both = _applied(placed, plan(placed), ("conv",)).drop("row")

    def fold(items: Iterator[tuple]) -> Iterator[tuple]:
        at, walk, found = _NOTHING, None, None
        for conv, pos, letters, state, name, body, *counts in items:
            if pos >= 0:
                found.add(walk.edit(name), body)
                continue
            if walk:
                found.add(walk.rest(), "")
            if conv != at:
                if found:
                    yield at, *found.row()
                at, found = conv, Report(counts.pop())
            walk = Walk(letters, state)
            found.count(letters, *counts[:7])
        if found:
            found.add(walk.rest(), "")
            yield at, *found.row()

    schema = T.StructType([placed.schema["conv"], *_fields(
        gaps="bigint", blank="bigint", duplicate="bigint", truncated="bigint", illegal="bigint", cost="bigint", audit="string", repaired_sha256="string",
    )])
    return _stream(both, ["conv", "pos", "letters", "before", "role", "text", *COUNTS], schema, fold)


class Report:
    """What is summed up and hashed over one conversation."""

    def __init__(self, cost: int) -> None:
        self.cost, self.faults, self.turns, self.ends = cost, [0] * 4, 0, []
        self.letters, self.digest, self.filled = [], hashlib.sha256(), False

    def count(self, letters: str, blank: int, duplicate: int, truncated: int, illegal: int, first: int | None, last: int | None, turns: int) -> None:
        self.letters.append(letters)
        self.faults = [a + b for a, b in zip(self.faults, (blank, duplicate, truncated, illegal))]
        self.turns += turns
        if first is not None:
            self.ends = [min([first, *self.ends]), max([last, *self.ends])]

    def add(self, made: Iterator[tuple[str, str | None]], body: str | None) -> None:
        for letter, role in made:
            if letter != "D":
                line = f"{role}:{'' if letter == 'I' else body or ''}"
                self.digest.update((("\n" if self.filled else "") + line).encode())
                self.filled = True

    def row(self) -> tuple:
        gaps = self.ends[1] - self.ends[0] + 1 - self.turns if self.ends else 0
        return gaps, *self.faults, self.cost, "".join(self.letters), self.digest.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` with faults that the CRC-32 of ``conv_id:turn`` chooses: of twenty rows one goes,
    one loses its text, one its sentence ends, one is repeated and one is given to the user. NULLs count as one space."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    return rows.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def report_all(rows: DataFrame, ids: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``report`` with a row for every value of ``ids``' column ``conv``; those without rows have zeros and an empty audit."""
    found = report(rows, conv).withColumnRenamed("conv", "_conv")
    every = ids.select(F.col(conv)).distinct()
    joined = every.join(found, F.col(conv).eqNullSafe(F.col("_conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        conv, *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
