import numpy as np
import pytest

from moodlake.llm import ann
from moodlake.llm.queries import QUERIES


def brute(rows, k=20):
    """query id -> [(vec_id, score)], exact."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            scores = ann._scores(x, q)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) / max(1, len(near)) for q, near in want.items()])


def test_query_recall_and_scores(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows), by_query(QUERIES["op4_nearest_neighbours"](spark, sf).collect())
    assert set(got) == set(want) and recall(got, want) >= 0.9
    exact = {q: dict(brute(rows, len(rows))[q]) for q in list(want)[:3]}
    for q, all_scores in exact.items():
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0])) and len(got[q]) == 20
        assert all(all_scores[i] == s for i, s in got[q])


def test_many_copies_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "INDEX_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(2)
    hot = [0.5, -1.0, 2.0, 0.25]
    rows = [(i, hot if i % 3 == 0 else [float(np.float32(x)) for x in rng.standard_normal(4)]) for i in range(400)]
    bad = [(400, None), (420, [0.0] * 4), (440, [1.0, None, 1.0, 1.0]), (460, [float("nan"), 1.0, 1.0, 1.0]), (480, [float("inf")] * 4), (500, [1.0, 2.0]), (None, hot)]
    frame = spark.createDataFrame(rows + bad + rows[:5], "vec_id long, embedding array<float>").withColumnRenamed("vec_id", "vec_id")
    want, got = brute(rows), by_query(ann.search(frame).collect())
    assert set(got) == set(want) and recall(got, want) >= 0.9
    assert got[0] == want[0] and got[60] == want[60]  # the copies with the smallest ids, own id left out


def test_few_and_no_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert by_query(ann.search(frame).collect()) == {0: [(1, 0.5), (2, 0.5)]}
    assert ann.search(frame.filter("vec_id = 0")).count() == 0
    assert ann.search(frame.filter("false")).count() == 0


def test_tests_abandon_but_rarely_err():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 64))
    space = ann.Space(x, len(x), float(np.sqrt((x**2).sum(axis=1)).max()))
    placed, q = space.place(x), rng.standard_normal(64)
    aimed = space.place(q[None], True)[0]
    exact = np.argsort(-(x @ q))[:21]
    rows = ann._scan(x, placed, q, aimed, -np.inf, space.longest, 21)
    assert len(rows) == 21 and len(set(rows) & set(exact)) >= 20
    assert ann._scores(x[rows], q) == pytest.approx(x[rows] @ q)
