import hashlib
import random
import re

import pytest
from conftest_paths import SMALL

from moodlake.llm import substring
from moodlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """doc_id -> kept words, by comparing all windows in order of id and place."""
    seen, kept = set(), {}
    for i in sorted(rows):
        words = WORD.findall(rows[i] or "")
        gone = set()
        for s in range(len(words) - 19):
            k = tuple(words[s:s + 20])
            if k in seen:
                gone.update(range(s, s + 20))
            seen.add(k)
        kept[i] = (words, [w for j, w in enumerate(words) if j not in gone])
    return kept


def check(got, rows):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        words, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.text) == (len(words), len(words) - len(kept), " ".join(kept))


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = brute(rows)
    for r in QUERIES["op7_substring_dedup"](spark, SMALL).collect():
        words, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (len(words), len(words) - len(kept))
        assert r.kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("step, bits", [(50, 10), (1_000_000, 20)])
def test_planted_repeats(spark, monkeypatch, step, bits):
    """Passages inside, across and within documents, short periods, just below the length; a saturated table too."""
    monkeypatch.setattr(substring, "STEP", step)
    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdef", k=3))
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 35, 60)]
    rows = {}
    for i in range(80):
        parts = []
        for _ in range(r.randint(0, 4)):
            parts += [word() for _ in range(r.randint(0, 30))]
            p = r.choice(passages)
            parts += r.choice([p, p[:20], p[5:], p + p])
        rows[i * 7 % 80] = r.choice([" ", "\n", " \t "]).join(parts)
    rows[90], rows[91], rows[92] = "x " * 100, "x y " * 30, "x " * 21
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    check(substring.remove_repeats(frame, bits=bits).collect(), rows)


def test_edges(spark, edge_docs, no_docs):
    got = substring.remove_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[5].n_words == by[6].n_words and by[6].n_removed == by[6].n_words  # 6 repeats 5
    assert by[0].n_words == 0 and by[None].n_removed == 0
    assert substring.remove_repeats(no_docs).count() == 0
    twice = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))] * 2, "doc_id long, text string")
    assert [r.n_removed for r in substring.remove_repeats(twice).collect()] == [0, 0]
