import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest_paths import SMALL

from moodlake.llm import sharding
from moodlake.llm.queries import QUERIES


def brute(keyed, shards):
    """Cut the sorted keys where the bytes below are nearest to each shard's target; ties go low."""
    rows = sorted(keyed, key=lambda r: (r.k1, r.k2))
    ends = [0, *np.cumsum([r.size for r in rows]).tolist()]
    cuts = [min(range(len(ends)), key=lambda i: (abs(ends[i] - ends[-1] * k / shards), i)) for k in range(1, shards)]
    out = []
    for n, r in enumerate(rows):
        shard = bisect.bisect_right(cuts, n)
        out.append((r.k1, r.k2, r.size, shard, n - ([0, *cuts][shard])))
    return out


def sharded(keyed, **settings):
    keyed = keyed.withColumn("row", keyed.row.withField("_k1", keyed.k1).withField("_k2", keyed.k2))
    rows = sharding.shard(keyed, **settings).select("row.*", "size", "shard", "slot").collect()
    return sorted((r._k1, r._k2, r.size, r.shard, r.slot) for r in rows)


def test_exact_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)
    keyed = sharding.packed(docs, keep_text=False)
    for shards, piece in ((8, 1 << 26), (8, 5000), (3, 20000), (1, 9000)):
        assert sharded(keyed, shards=shards, tolerance=0.0, piece_bytes=piece) == brute(keyed.collect(), shards)


def check(rows, shards=8, tolerance=sharding.TOLERANCE):
    slots, size = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(size.values()) / shards
    largest = max((r.size for r in rows), default=0)
    assert all(abs(size[k] - share) <= 2 * (largest + tolerance * share) for k in range(shards))


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = QUERIES["op11_sharding"](spark, SMALL).collect()
    got = sorted((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows)
    assert got == sorted((d.doc_id, len(d.text.encode()) + 1, zlib.crc32(d.text.encode()), "bytes", None) for d in docs.collect())
    check(rows)


def test_a_group_of_copies_larger_than_a_shard_is_cut(spark):
    rows = [(None, "the same text")] * 3000 + [(i, f"text {i} " * (i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    done = sharding.shard(sharding.packed(df), piece_bytes=4096).collect()
    check(done)
    shards = {r.shard for r in done if r.row.text == "the same text"}
    assert len(shards) > 2 and max(shards) - min(shards) == len(shards) - 1
    cut = [t for t, n in Counter(t for t, _ in {(r.row.text, r.shard) for r in done}).items() if n > 1]
    assert len(cut) <= 7


def test_below_counts_probes_of_two_numbers():
    probes = [(1, 5), (1, 7), (1, 7), (3, 0)]
    keys = [(0, 9), (1, 4), (1, 5), (1, 7), (1, 9), (2, 0), (3, 0), (4, -1)]
    found = sharding.below(*np.array(keys).T, *np.array(probes).T)
    assert found.tolist() == [sum(p <= k for p in probes) for k in keys]


def test_edges(spark, edge_docs, no_docs, folder):
    done = sharding.shard(sharding.packed(edge_docs)).collect()
    assert sorted(map(str, (r.row for r in done))) == sorted(map(str, edge_docs.collect()))
    assert [r["size"] for r in done if r.row.doc_id in (0, 1)] == [1, 1] and {r.crc for r in done if r.row.doc_id in (0, 1)} == {0}
    check(done)
    assert sharding.shard(sharding.packed(no_docs)).collect() == []
    clashing = edge_docs.withColumnsRenamed({"words": "row", "kept": "shard", "fp": "k1", "n": "size"})
    sharding.write(clashing, f"{folder}/out")
    back = spark.read.parquet(f"{folder}/out").orderBy("shard", "slot")
    assert sorted(map(str, (r.row for r in back.collect()))) == sorted(map(str, clashing.collect()))
    one = spark.createDataFrame([("a",), (None,)], "text string")
    assert sharding.shard(sharding.packed(one, keep_text=False)).count() == 2
