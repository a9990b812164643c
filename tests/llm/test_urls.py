import random
import re
from itertools import combinations

import pytest
from conftest_paths import SMALL

from moodlake.llm import urls
from moodlake.llm.queries import QUERIES

GIVEN = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in GIVEN if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_query_equals_brute_force(spark):
    links = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = QUERIES["op9_url_filter"](spark, SMALL).collect()
    assert len(got) == len(links)
    for r in got:
        host, path, rule, verdict = brute(links[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.mined_rule is not None else "allow"))


EDGES = [
    None, "", "no scheme", "http://", "http://NET/", "https://a.NET", "ftp://x.net?q=/en/", "http://EXAMPLE.net/en/x#y", "http://aexample.net/en/",
    "http://example.com/de", "http://example.com/de/?a=1&b=2", "http://x.org/fr/http://y.net/", "//org/fr/", "http://org/fr/a?b#c", "x://É.net/a b",
    "http://x.net/" + "a/" * 20000, "http://" + "a." * 5000 + "net/", "a://b://c/d", "http://h\n.net/\n",
]


def test_edges(spark):
    frame = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(EDGES + EDGES[:4])], "page_id long, url string, host string, rule string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = urls.judge(frame, none).collect()
    assert len(got) == len(EDGES) + 4
    for r in got:
        assert (r.host, r.path, r.rule) == brute(r.row.url)[:3]
        assert r.verdict == (brute(r.row.url)[3] or "allow")
    assert urls.judge(frame.filter("false"), none).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    """Casino pages of one host are bad, the rest is good; either token alone is not enough."""
    rows = []
    for i in range(400):
        host, part = ("spam.example.org" if i % 2 else "good.example.org"), ("casino" if i % 4 < 2 else "news")
        rows.append((f"http://{host}/{part}/{i}.html?x={i}", host.startswith("spam") and part == "casino"))
    return spark.createDataFrame([*rows, ("http://null.example.org/", None)], "url string, bad boolean")


def test_mined_combination_blocks(spark, labelled):
    rules = urls.mine(labelled).collect()
    assert rules and all({"host:spam.example.org", "path0:casino"} <= set(r.tokens) or r.confidence >= 0.8 for r in rules)
    links = ["http://spam.example.org/casino/9.html?x=1", "http://spam.example.org/news/9.html", "http://good.example.org/casino/1", "http://spam.example.org/casino/other"]
    got = {r.row.url: r.verdict for r in urls.judge(spark.createDataFrame([(u,) for u in links], "url string"), labelled).collect()}
    assert got == {links[0]: "block", links[1]: "allow", links[2]: "allow", links[3]: "block"}


def test_matching_equals_subset_test(spark, labelled, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_ROWS", 0)
    rules = urls.mine(labelled, min_confidence=0.3)
    hits = {r.url: r.rule_id for r in urls.matched(labelled, rules).collect()}
    known = {r.rule_id: set(r.tokens) for r in rules.collect()}
    held = {r.url: set(r.t) for r in labelled.select("url", urls.tokens("url").alias("t")).collect()}
    want = {u: min(i for i, need in known.items() if need <= t) for u, t in held.items() if any(need <= t for need in known.values())}
    assert hits == want


def test_unlabelled_corpus_mines_nothing(spark):
    assert urls.mine(spark.createDataFrame([("http://a.b/c", False)] * 50, "url string, bad boolean")).count() == 0


def brute_rules(rows, support, confidence):
    """All token sets, tried one by one: antecedent -> confidence, without those a smaller one equals."""
    tokens = sorted({t for held, _ in rows for t in held})
    found = {}
    for n in range(1, len(tokens) + 1):
        for chosen in combinations(tokens, n):
            held = [bad for t, bad in rows if set(chosen) <= t]
            if sum(held) >= support * len(rows) and held and sum(held) >= confidence * len(held):
                found[frozenset(chosen)] = sum(held) / len(held)
    return {k: c for k, c in found.items() if not any(found.get(k - {t}, -1) >= c for t in k)}


def test_rules_equal_a_brute_force_miner(spark):
    rng = random.Random(1)
    links = []
    for i in range(60):
        host, part = rng.choice(["a.x", "b.x"]), rng.choice(["p", "q"])
        links.append((f"http://{host}/{part}?k=1&l=2" if rng.random() < 0.5 else f"http://{host}/{part}", host == "a.x" and (part == "p" or rng.random() < 0.3)))
    frame = spark.createDataFrame(links, "url string, bad boolean")
    held = [(frozenset(r.t), r.bad) for r in frame.select(urls.tokens("url").alias("t"), "bad").collect()]
    rules = urls.mine(frame, min_support=0.05, min_confidence=0.7).collect()
    name = {t: min(part.members) for rule in rules for part in rule.parts for t in part.members}
    want = {}
    for chosen, sure in brute_rules(held, 0.05, 0.7).items():
        closed = frozenset(name.get(t, t) for t in chosen)
        want[closed] = sure
    assert {frozenset(r.tokens): round(r.confidence, 9) for r in rules} == {k: round(c, 9) for k, c in want.items()}
    # Whatever single rules a part stands for, a URL fires by them exactly if it fires by the rule.
    fired = {r.url for r in urls.matched(frame, urls.mine(frame, min_support=0.05, min_confidence=0.7)).collect()}
    single = brute_rules(held, 0.05, 0.7)
    assert fired == {u for (u, _), (t, _) in zip(links, held) if any(k <= t for k in single)}


def test_many_parameters_on_a_hot_page(spark):
    """Forty parameters that always come together are one token, not 2^40 combinations."""
    query = "&".join(f"k{i}=1" for i in range(40))
    rows = [(f"http://bad.example/x?{query}", True)] * 30 + [(f"http://good.example/y{i}", False) for i in range(70)]
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    rules = urls.mine(frame)
    assert rules.count() <= 3
    links = [f"http://bad.example/x?{query}", "http://other.example/z?k7=2", "http://good.example/y1"]
    got = {r.row.url: r.verdict for r in urls.judge(spark.createDataFrame([(u,) for u in links], "url string"), frame).collect()}
    assert got == {links[0]: "block", links[1]: "block", links[2]: "allow"}
