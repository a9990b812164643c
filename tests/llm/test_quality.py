import re
from collections import Counter

from conftest_paths import SMALL

from moodlake.llm import quality
from moodlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_on_edges(edge_docs):
    got = quality.text_measures(edge_docs).select("text", "_quality.*").collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op1_quality_rules"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        n, chars, symbols, dup, repeat = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert not (r.base_failed and r.kept)


def test_host_decides_mild_rules(spark):
    bad, good = " ".join(f"w{i} #" for i in range(30)), " ".join(f"word{i}" for i in range(30))
    rows = [(i, bad if i < 90 else good, "bad") for i in range(100)] + [(100 + i, bad if i < 3 else good, "good") for i in range(100)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.doc_id for r in got.filter("kept").collect()}
    assert kept == set(range(90, 200))


def test_shrinkage_draws_small_hosts_to_the_mean(spark):
    bad, good = " ".join(f"w{i} #" for i in range(30)), " ".join(f"word{i}" for i in range(30))
    rows = [(i, good if i % 20 else bad, f"h{i % 5}") for i in range(200)] + [(999, bad, "tiny")]
    measured = quality.text_measures(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    rates = {r.host: r for r in quality.host_rates(measured).collect()}
    assert rates["tiny"].symbols_failed == rates["tiny"].n_docs == 1
    assert rates["tiny"].symbols_rate < 0.95


def test_stage_form_and_empty(edge_docs, no_docs):
    kept = quality.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    assert quality.keep_good(no_docs).count() == 0
    assert quality.judge(no_docs).count() == 0


def test_one_host_and_many_hosts(spark):
    rows = [(i, " ".join(f"word{i}" for i in range(30)), f"h{i}" if i % 3 else "hot") for i in range(3000)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert got.count() == 3000 and got.filter("kept").count() == 3000


def test_single_document_hosts_are_not_blamed_for_their_own_failure(spark):
    """The spread of such hosts is sampling noise; a host that fails in general still stands out."""
    bad, good = " ".join(f"w{i} #" for i in range(30)), " ".join(f"word{i}" for i in range(30))
    rows = [(i, good if i % 10 else bad, f"h{i}") for i in range(1000)]
    fields = "doc_id long, text string, source string"
    assert quality.judge(spark.createDataFrame(rows, fields)).filter("kept").count() == 1000
    pair = [(2000, bad, "pair"), (2001, bad, "pair")]
    assert quality.judge(spark.createDataFrame(rows + pair, fields)).filter("kept AND doc_id < 1000").count() == 1000
    large = [(3000 + i, good if i % 10 else bad, f"large{i % 4}") for i in range(400)] + [(5000 + i, bad, "worst") for i in range(30)]
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(rows + large, fields)).filter("kept").collect()}
    assert kept >= set(range(1000)) and {n for n in kept if n >= 5000} == set()


def test_judge_keeps_columns_with_names_of_its_own(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(30 + i)), "h", 7, 8, 9, 1) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _bad int, _hot int, _host int, _n int")
    out = quality.judge(docs)
    assert out.columns[:7] == docs.columns
    assert sorted(tuple(r)[:7] for r in out.collect()) == sorted(rows)
