import hashlib
import random
import re
import zlib
from collections import defaultdict
from math import inf

import pytest
from conftest_paths import SMALL

from moodlake.llm import turns
from moodlake.llm.queries import QUERIES

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def next_state(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def best(rows):
    """Cheapest edits and the repaired lines by a plain search over prefixes: every state keeps its least (cost, letters)."""
    def inserts(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                for role in ("user", "assistant"):
                    to = next_state(state, role[0])
                    if to:
                        put(states, to, (cost + 5, audit + "I", lines + [role + ":"]))

    def put(states, to, value):
        if to not in states or value[:2] < states[to][:2]:
            states[to] = value

    states = {"": (0, "", [])}
    inserts(states)
    for role, text, fault in rows:
        later = {}
        for state, (cost, audit, lines) in states.items():
            put(later, state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if to := next_state(state, role[:1]):
                put(later, to, (cost + more, audit + "K", lines + [f"{role}:{text}"]))
            for name in ("user", "assistant"):
                if to := next_state(state, name[0]):
                    put(later, to, (cost + more + 1, audit + "R", lines + [f"{name}:{text}"]))
        states = later
        inserts(states)
    return min((states[s] for s in ("", "a") if s in states), key=lambda v: v[:2])


def brute(rows):
    """Rows (turn, role, text) of one conversation in order -> the columns of the report."""
    seen, judged = set(), []
    for _, role, text in rows:
        body = BLANK.findall(text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[:1] for r, *_ in judged]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = best(judged)
    faults = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
    return gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def by_conv(rows):
    groups = defaultdict(list)
    for conv, *rest in rows:
        groups[conv].append(tuple(rest))
    return {c: sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for c, g in groups.items()}


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reported(df, conv="conv"):
    return {r[conv]: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: brute(g) for c, g in by_conv(damaged(rows)).items()}
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reported(QUERIES["op12_conversation_repair"](spark, SMALL), "conv_id") == {c: want.get(c, none) for c, *_ in rows}


def made(seed, convs, most):
    rng, rows = random.Random(seed), []
    for conv in range(convs):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "system", "tool", "user", "assistant", ""])
            rows.append((conv if conv else None, turn if rng.random() < 0.9 else turn + 2, role, rng.choice(["", " \n", "Yes.", "No", "Why?", f"text {rng.random()}!", f"t {turn}"])))
    return list(dict.fromkeys(rows))


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_random_conversations_over_any_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(turns, "BLOCK_BITS", bits)
    # Turns are made distinct here: what decides ties is a hash.
    rows = [(c, 2 * i, r, t) for i, (c, _, r, t) in enumerate(made(bits, 40, 14))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert reported(turns.report(df)) == {c: brute(g) for c, g in by_conv(rows).items()}


def test_walks_are_those_of_one_block():
    rng, step = random.Random(7), turns.Steps()
    for n in (1, 2, 5, 40, 200):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3, 5, 9, 14, 13]) for _ in range(n))
        names = ("system", "user", "assistant", "x")
        rows = [(names[c & 3], str(i), ("", "blank", "duplicate", "truncated")[c >> 2]) for i, c in enumerate(codes)]
        letters, state = turns.walks(codes, turns.END, step)[0]
        cost, audit, _ = best(rows)
        assert letters + "I" * int(turns.END[state] // 5) == audit
        assert turns.before(turns.matrix(codes, step), turns.END)[0] == cost < inf


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK_BITS", 5)
    rng = random.Random(3)
    rows = [(None, i, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"own {i}.", f"cut {i}", ""])) for i in range(3000)]
    rows += [(i, 0, "user", "alone.") for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    assert reported(turns.report(df)) == {c: brute(g) for c, g in by_conv(rows).items()}


def test_repair_gives_rows(spark):
    rows = [(1, 0, "system", "Be kind.", "x"), (1, 1, "assistant", "Hello.", "y"), (1, 2, "assistant", "", "z"), (2, 0, "user", "Hi.", "w")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    out = turns.repair(df).orderBy("conv", "place").collect()
    assert [(r.conv, r.edit, r.role, r.text, r.row.place if r.row else None) for r in out] == [
        (1, "D", None, "Be kind.", "x"), (1, "D", None, "Hello.", "y"), (1, "D", None, "", "z"), (2, "D", None, "Hi.", "w"),
    ] or [r.edit for r in out if r.conv == 1] == list(brute([r[1:4] for r in rows[:3]])[6])
    for conv in (1, 2):
        kept = [f"{r.role}:{r.text}" for r in out if r.conv == conv and r.edit != "D"]
        assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == brute([r[1:4] for r in rows if r[0] == conv])[7]
        assert "".join(r.edit for r in out if r.conv == conv) == brute([r[1:4] for r in rows if r[0] == conv])[6]


def test_edges(spark):
    long = "Alpha beta. " * 40000
    rows = [
        (None, None, None, None, 1), (None, None, "user", long, 2), (1, None, "user", "a.", 3), (1, 1, "assistant", "b.", 4), (1, 1, "assistant", "b.", 5),
        (2, 5, "user", "a\x1c", 6), (2, 9, "assistant", "　", 7), (3, 0, "", "x.", 8), (3, 1, "user", "x.", 9), (3, 1, "user", "x.", 9),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int").withColumnRenamed("pos", "row")
    plain = [(c, t, r or " ", x or "") for c, t, r, x, _ in rows]
    assert reported(turns.report(df)) == {c: brute(g) for c, g in by_conv(plain).items()}
    assert turns.repair(df).filter("row IS NOT NULL").count() == len(rows)
    none = df.filter("false")
    assert turns.report(none).collect() == [] == turns.repair(none).collect()
    assert turns.report_all(none, df).count() == 4
    assert turns.report_all(turns.damage(df.drop("row")), df).count() == 4
