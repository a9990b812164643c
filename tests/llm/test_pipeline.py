from collections import Counter

import corpus_pipeline
from conftest_paths import SMALL

from moodlake.llm import simhash


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    planted = " ".join(f"word{i}" for i in range(40)) + " password=hunter2secret"
    docs = docs.unionByName(docs.limit(1).selectExpr("10000L AS doc_id", f"'{planted}' AS text", "lang", "source", "n_chars"))
    before = {r.doc_id: r for r in docs.collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    single = corpus_pipeline.near_duplicates(spark, kept, SMALL)
    ids = [r.doc_id for r in single.collect()]
    fps = [simhash.fingerprint(before[i].text) for i in ids]
    assert all((a ^ b).bit_count() > 3 for x, a in enumerate(fps) for b in fps[:x])
    masked = corpus_pipeline.secret_scan(spark, single, SMALL).collect()
    assert sorted(r.doc_id for r in masked) == sorted(ids)
    assert all("[SECRET]" in r.text or r.text == before[r.doc_id].text for r in masked)
    assert [r.text for r in masked if r.doc_id == 10000] == [planted.replace("password=hunter2secret", "[SECRET]")]


def test_run_repeats_by_copies_and_reruns_agree(spark):
    first = Counter(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert max(first.values()) == 2
    assert first == Counter(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect())


def test_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        at = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, at, SMALL)
            assert out.columns == docs.columns, name
            at = out
        assert corpus_pipeline.byte_bpe(spark, at, SMALL).count() == at.count()
