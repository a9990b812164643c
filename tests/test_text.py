import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from moodlake.functions.text import clean_text, is_blank, keyword_sentiment, strip, tokens

EDGES = {
    "@switchfoot http://t.co/a - Awww, that's #bad naïve": " awww that s na ve",
    "xhttpfoo": "x",
    "HTTPfoo": "httpfoo",
    "@only": "",
    "@Üser hi": " ser hi",
    "": "",
    None: None,
    "#@ab c": " c",
    "a \t\n\x0b b": "a b",
    "@http://x y": " y",
    "😀 ok 😀": " ok ",
}


def test_clean_edges(evaluate):
    assert evaluate(clean_text, list(EDGES)) == list(EDGES.values())


def test_clean_options(evaluate):
    assert evaluate(lambda c: clean_text(c, drop_hashtags=False), ["#tag @me x"]) == [" tag x"]
    assert evaluate(lambda c: clean_text(c, trim=True), ["- a! "]) == ["a"]


def step_by_step(text):
    """The five cleaning steps as published, by Python's regex engine in ASCII mode."""
    space = "[ \t\n\x0b\f\r]"
    out = re.sub(f"http[^{space[1:-1]}]+", "", text)
    out = re.sub(r"@\w+", "", out, flags=re.A)
    out = re.sub(r"#\w+", "", out, flags=re.A)
    out = re.sub(r"[^a-zA-Z0-9 \t\n\x0b\f\r]", " ", out)
    return re.sub(f"{space}+", " ", out).lower()


pieces = st.sampled_from(["@", "#", "http", "://", " ", "\n", "\x0b", "\t", "a", "Zz9", "_", "é", "😀", "!", "\xa0", "h", "t"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=14).map("".join), min_size=40, max_size=40))
def test_three_passes_equal_five(evaluate, texts):
    out = evaluate(clean_text, texts)
    assert out == [step_by_step(t) for t in texts]
    assert all(re.fullmatch("[a-z0-9 ]*", t) for t in out)


def test_cleaning_has_no_python_node(spark, frame):
    plan = frame(["x"]).select(clean_text("c"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_strip_is_python_strip(evaluate):
    texts = [" a ", " 　b\x1c", "\t\n", "", "c​", None]
    assert evaluate(strip, texts) == [t if t is None else t.strip() for t in texts]
    assert evaluate(is_blank, texts) == [not (t or "").strip() for t in texts]


def test_tokens_match_ml_tokenizer(spark, frame, evaluate):
    texts = [" hi", "hi ", "a  B", "", " ", "  \t", "x\n\ny ", "a b"]
    df = frame(texts)
    ml = {r.n: r.t for r in Tokenizer(inputCol="c", outputCol="t").transform(df).collect()}
    assert evaluate(tokens, texts) == [ml[i] for i in range(len(texts))]
    assert evaluate(tokens, ["hi ", " hi", None]) == [["hi"], ["", "hi"], None]


@pytest.mark.parametrize("text, label", [
    ("amazing!", "Positive"), ("terrible", "Negative"), ("the prefix", "Negative"),
    ("it arrived", "Neutral"), ("GAME CHANGER", "Positive"), (None, "Neutral"),
])
def test_keyword_label(evaluate, text, label):
    assert evaluate(lambda c: keyword_sentiment(c, F.lit("k")), [text]) == [label]


def test_keyword_tie_by_parity(evaluate):
    keys = [str(i) for i in range(20)]
    want = ["Positive" if int(hashlib.md5(k.encode()).hexdigest(), 16) % 2 == 0 else "Negative" for k in keys]
    assert evaluate(lambda c: keyword_sentiment(F.lit("best but broken"), c), keys) == want
    assert set(want) == {"Positive", "Negative"}
