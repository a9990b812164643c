import base64
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from conftest_paths import SMALL

from moodlake.llm import rollup
from moodlake.llm.queries import QUERIES


def library(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_brute_force(spark):
    one, two = library("byte_bpe_50k.tiktoken"), library("byte_bpe_multi_50k.tiktoken")
    docs, tokens = Counter(), Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        english = r.lang == "en"
        key = (r.source, r.lang, "byte_bpe_50k" if english else "byte_bpe_multi_50k")
        docs[key] += 1
        tokens[key] += len((one if english else two).encode_ordinary(r.text or ""))
    got = QUERIES["op5_token_counts"](spark, SMALL).collect()
    assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in got} == {k: (docs[k], tokens[k]) for k in docs}


@pytest.fixture
def changes(spark):
    def make(*rows):
        return spark.createDataFrame(rows, "op string, id long, version string, source string, lang string, n_tokens long")

    return make


def sums(spark, root):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals(spark, root).collect()}


def test_signed_batches_are_idempotent(spark, folder, changes):
    first = changes(("insert", 1, "v", "a", "en", 10), ("insert", 2, "v", "a", "en", 5), ("insert", 3, "v", None, None, 7), ("insert", None, "v", "b", "en", 1))
    assert rollup.totals(spark, folder).count() == 0
    assert rollup.commit(spark, folder, "b1", first)
    assert not rollup.commit(spark, folder, "b1", first)
    assert sums(spark, folder) == {("a", "en", "v"): (2, 15), (None, None, "v"): (1, 7), ("b", "en", "v"): (1, 1)}
    second = changes(
        ("revise", 1, "v", "a", "en", 12), ("delete", 2, "v", None, None, None), ("delete", 99, "v", "a", "en", 4),
        ("insert", 3, "v", "c", "de", 8), ("insert", 4, "w", "a", "en", 2), ("insert", 4, "w", "a", "en", 2), ("delete", None, "v", None, None, None),
    )
    for _ in range(3):
        rollup.commit(spark, folder, "b2", second)
    assert sums(spark, folder) == {("a", "en", "v"): (1, 12), ("c", "de", "v"): (1, 8), ("a", "en", "w"): (2, 4)}
    assert rollup.commit(spark, folder, "b3", changes(("insert", 2, "v", "a", "en", 5)))
    assert sums(spark, folder)["a", "en", "v"] == (2, 17)
    assert rollup.current(spark, folder).count() == 4


def test_interrupted_batch_is_not_read(spark, folder, changes):
    rollup.commit(spark, folder, "b1", changes(("insert", 1, "v", "a", "en", 10)))
    left = changes(("insert", 5, "v", "a", "en", 100))
    left.selectExpr("source", "lang", "version", "1L AS n_docs", "n_tokens").write.parquet(f"{folder}/deltas/b2")
    assert sums(spark, folder) == {("a", "en", "v"): (1, 10)}
    rollup.commit(spark, folder, "b2", left)
    assert sums(spark, folder) == {("a", "en", "v"): (2, 110)}


def test_edges(spark, folder, edge_docs, no_docs):
    path = P.path("byte_bpe_50k.tiktoken")
    assert rollup.counted(no_docs, "v", path, P.PATTERN).count() == 0
    rows = rollup.counted(edge_docs, "v", path, P.PATTERN)
    assert rows.count() == edge_docs.count()
    rollup.commit(spark, folder, "all", rows)
    assert sum(n for n, _ in sums(spark, folder).values()) == edge_docs.count()
    rollup.commit(spark, folder, "none", rows.filter("false"))
    assert len(rollup.commits(spark, folder)) == 2


def test_repeated_and_missing_ids_count_with_every_row(spark, folder, changes):
    first = [("insert", None, "v", "a", "en", 3), ("insert", None, "v", "b", "en", 4), ("insert", 1, "v", "a", "en", 5), ("insert", 1, "v", "a", "en", 5)]
    rollup.commit(spark, folder, "b1", changes(*first))
    assert sums(spark, folder) == {("a", "en", "v"): (3, 13), ("b", "en", "v"): (1, 4)}
    rollup.commit(spark, folder, "b2", changes(("revise", 1, "v", "c", "en", 9), ("delete", 1, "v", None, None, None), ("delete", None, "v", None, None, None)))
    assert sums(spark, folder) == {("c", "en", "v"): (1, 9)}
    rollup.commit(spark, folder, "b3", changes(*first))
    assert sums(spark, folder) == {("a", "en", "v"): (3, 13), ("b", "en", "v"): (1, 4)}
