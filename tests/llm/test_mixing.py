import re
from collections import defaultdict

import pytest
from conftest_paths import SMALL
from pyspark.sql import functions as F

from moodlake.llm import mixing
from moodlake.llm.queries import QUERIES


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Deal by weight, stop at the limit, deal the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, open_, rest = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while rest > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            got[s] += rest * w[s] / total
        rest = sum(max(0.0, got[s] - cap * sizes[s]) for s in open_)
        for s in list(open_):
            if got[s] >= cap * sizes[s]:
                got[s] = cap * sizes[s]
                open_.discard(s)
    return got


def check(rows, docs):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        s, text = docs[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[s] += r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    want = brute_targets(sizes)
    for r in rows:
        s = docs[r.doc_id][0]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9, abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


@pytest.mark.parametrize("sf", [SMALL, "/root/testdata/sf0.01"])
def test_query_meets_targets(spark, sf):
    docs = {r.doc_id: (r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op6_source_mixing"](spark, sf).collect()
    assert len(rows) == len(docs)
    check(rows, docs)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pick = lambda d: sorted((r.row.doc_id, r.copies) for r in mixing.mix(d).select("row", "copies").collect())
    assert pick(docs) == pick(docs.repartition(7))


def test_inclusion_follows_the_expected_copies(spark):
    """Over some seeds a document is taken about as often as its expected copies say; larger ones less often."""
    docs = spark.createDataFrame([(i, "w " * (4 if i % 2 else 64), "s" if i < 120 else "t") for i in range(180)], "doc_id long, text string, source string")
    counts = defaultdict(float)
    for seed in range(3):
        for r in mixing.mix(docs, seed=seed).filter("row.source = 's'").select("row.doc_id", "copies").collect():
            counts[r.doc_id] += r.copies / 3
    small = sum(v for k, v in counts.items() if k % 2) / 60
    large = sum(v for k, v in counts.items() if not k % 2) / 60
    assert 0 < large < small <= 2


def test_edges(spark, edge_docs, no_docs):
    mixed = mixing.mix(edge_docs)
    assert mixed.count() == edge_docs.count()
    assert {r.copies for r in mixed.filter("size = 0").collect()} == {0}
    out = mixing.repeat(edge_docs)
    assert out.columns == edge_docs.columns and out.count() > 0
    assert mixing.repeat(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    only_empty = edge_docs.filter("text IS NULL")
    assert mixing.repeat(only_empty).count() == 0
    copies = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert max(r.n for r in copies if r.doc_id != 4) <= 2


def test_rows_without_an_id_have_ranks_of_their_own(spark):
    """All ids NULL and sizes equal: each source still comes near its target."""
    rows = spark.range(6000, numPartitions=4).select(
        F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
        F.repeat(F.lit("w "), 20).alias("text"),
    )
    mixed = mixing.mix(rows).groupBy("row.source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"))
    for r in mixed.collect():
        assert abs(r.taken - r.target) <= 20
