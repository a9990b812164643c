import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from conftest_paths import SMALL

from moodlake.llm import simhash
from moodlake.llm.components import stars
from moodlake.llm.queries import QUERIES


def brute_fp(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps):
    """Smallest id reachable over links of at most three bits."""
    ids, root = list(fps), {}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[:x]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def rows(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_query_equals_brute_force(spark, rows):
    fps = {i: brute_fp(t) for i, t in rows.items()}
    classes = brute_classes(fps)
    got = QUERIES["op3_simhash_near_dedup"](spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == classes[r.doc_id]


@pytest.mark.parametrize("block", [2, 7, 512])
def test_links_connect_like_all_pairs(spark, block):
    """Dense and sparse fingerprints, with and without blocks."""
    rng = np.random.default_rng(5)
    fps = {int(x) for x in rng.integers(0, 1 << 63, 40)}
    centre = int(rng.integers(0, 1 << 63))
    for _ in range(60):
        fps.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)))
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), block=block).collect()
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    assert all(near(r.a, r.b) for r in found)

    def groups(pairs):
        root = {f: f for f in fps}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            p, q = sorted((find(a), find(b)))
            root[q] = p
        out = defaultdict(set)
        for f in fps:
            out[find(f)].add(f)
        return sorted(map(sorted, out.values()))

    assert groups([(r.a, r.b) for r in found]) == groups([(a, b) for a in fps for b in fps if a < b and near(a, b)])


def test_long_chain_of_links(spark):
    chain = [(i + 1, i) for i in range(200)] + [(500, 501), (501, 500), (900, 901), (7, 7)]
    got = {r.node: r.root for r in stars(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500, 901: 900}
    assert stars(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_edges(edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs)
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    assert {by[i][0].component_id for i in (0, 1, 2)} == {0}
    assert {r.component_id for r in by[4]} == {4} and len(by[4]) == 3
    assert by[6][0].component_id == 5
    assert by[None][0].component_id is None
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 2, 6}.isdisjoint(ids) and {0, 4, 5, None} <= set(ids)
    assert simhash.keep_one(no_docs).count() == 0


def test_rows_that_share_an_id_or_have_none_stand_for_themselves(spark):
    """Different texts stay whatever their ids; a copy goes although its id is repeated."""
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    a, b, c, d = texts
    rows = [(None, c), (None, d), (None, d), (3, a), (5, a), (5, b), (7, b), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(None, c), (None, d), (3, a), (5, b), (8, "")], key=str)


def test_keep_one_against_brute_force(spark):
    """Light edits, copies, repeated and missing ids, columns with names the operator uses itself."""
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{k}" for k in rng.integers(0, 4000, 60 + i)) for i in range(30)]
    texts = [*base, *base[:12], None, "", "short", "short one", "short"]
    for text in base[:25]:
        words = text.split()
        words[int(rng.integers(0, len(words)))] = "edited"
        texts.append(" ".join(words))
    rows = [(None if i % 9 == 0 else int(rng.integers(0, 60)), t, i, b"k", 0) for i, t in enumerate(texts)]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class int, key binary, root int").repartition(3)
    fps = [simhash.fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fps):
        for j, b in enumerate(fps[:i]):
            if (a ^ b).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (n, t, place, *_) in enumerate(rows):
        # A NULL text is smaller than the empty one, as in Spark.
        order = (n is None, n or 0, t is not None, t or "", place)
        least[find(i)] = min(least.get(find(i), order), order)
    kept = [(r.doc_id is None, r.doc_id or 0, r.text is not None, r.text or "", r["class"]) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted(least.values()) and len(kept) < len(rows) - 15
