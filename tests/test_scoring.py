import json
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from moodlake.functions.predictions import top_prediction
from moodlake.functions.text import keyword_sentiment
from moodlake.operators.scoring import (
    ModelLoading, RateLimited, Rest, RetryPolicy, call_scorer, keyword_scorer, score, score_columns, score_distinct, score_keywords,
    score_responses,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FALLBACK = ("Neutral", 0.0, "api_unavailable")


def no_sleep(_seconds):
    pass


QUICK = RetryPolicy(sleep=no_sleep)


def results(df, key="id"):
    return {
        r[key]: (r.sentiment_label, round(r.confidence_score, 4), r.inference_error) for r in df.collect()
    }


def posts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, cleaned_text string")


def test_top_prediction(evaluate):
    def answer(*pairs):
        return json.dumps([[{"label": a, "score": s} for a, s in pairs], []])

    cases = {
        answer(("LABEL_0", 0.4), ("LABEL_2", 0.5), ("LABEL_1", 0.5)): ("Positive", 0.5, None),
        answer(("LABEL_1", 1)): ("Neutral", 1.0, None),
        answer(("X", 0.25)): ("X", 0.25, None),
        answer(("LABEL_0", 0.0)): ("Negative", 0.0, None),
        answer(("LABEL_0", 0.4), ("LABEL_2", None)): FALLBACK,
        '[[{"label":"LABEL_0"}]]': FALLBACK,
        '[{"label":"LABEL_0","score":1}]': FALLBACK,
        "[[]]": FALLBACK, "[]": FALLBACK, "{}": FALLBACK, "oops": FALLBACK, "": FALLBACK, None: FALLBACK,
    }
    assert [tuple(r) for r in evaluate(top_prediction, list(cases))] == list(cases.values())


def test_score_json(evaluate):
    from moodlake.functions.payload import parse_score

    texts = ['{"label":"Positive","score":0.5,"error":null}', '{"label":"Positive","score":"0.5"}', "no"]
    assert [tuple(r) for r in evaluate(parse_score, texts)] == [
        ("Positive", 0.5, None), ("Positive", None, None), (None, None, None),
    ]


def test_blank_text_never_reaches_the_scorer(spark):
    def factory():
        def run(texts):
            assert all(t.strip() for t in texts)
            return [("LABEL_2", 0.75)] * len(texts)
        return run

    got = results(score(posts(spark, ["a", "", "  ", None, "b"]), factory, retry=QUICK))
    empty = ("Neutral", 0.0, "empty_text")
    good = ("Positive", 0.75, None)
    assert got == {0: good, 1: empty, 2: empty, 3: empty, 4: good}


def bad_factories():
    def raising(texts):
        raise ValueError("no")

    return [
        raising,
        lambda texts: [],
        lambda texts: [("Positive", 1.0)] * (len(texts) + 1),
        lambda texts: None,
        lambda texts: ["Positive"] * len(texts),
        lambda texts: [("Positive", None)] * len(texts),
    ]


@pytest.mark.parametrize("i", range(6))
def test_failing_scorer_keeps_every_row(spark, i):
    got = results(score(posts(spark, ["a", "b", "c"]), lambda: bad_factories()[i], retry=QUICK))
    assert got == {0: FALLBACK, 1: FALLBACK, 2: FALLBACK}


def test_one_bad_text_does_not_spoil_the_call():
    def scorer(texts):
        if "bad" in texts:
            raise ValueError
        return [("Positive", 1.0)] * len(texts)

    got = call_scorer(scorer, ["a", "b", "bad", "c", "d"], QUICK)
    assert got == [("Positive", 1.0, None)] * 2 + [FALLBACK] + [("Positive", 1.0, None)] * 2


def test_retries_and_waits():
    waits = []
    errors = [ModelLoading(), ModelLoading(12), RateLimited(), RateLimited(3), ValueError(), TimeoutError()]
    policy = RetryPolicy(attempts=7, sleep=waits.append)

    def scorer(texts):
        if errors:
            raise errors.pop(0)
        return [("LABEL_0", 0.5)]

    assert call_scorer(scorer, ["x"], policy) == [("Negative", 0.5, None)]
    assert waits == [20, 24, 10, 3, 32, 64]
    assert RetryPolicy().pause(ModelLoading(20), 2) == 30


def test_no_wait_after_the_last_attempt_and_no_halving_when_the_service_is_down():
    waits, calls = [], []

    def scorer(texts):
        calls.append(len(texts))
        raise TimeoutError

    assert call_scorer(scorer, ["a", "b"], RetryPolicy(sleep=waits.append)) == [FALLBACK] * 2
    assert waits == [2, 4] and calls == [2, 2, 2]


@pytest.mark.parametrize("error", [OSError, ConnectionResetError, RateLimited])
def test_a_dead_service_costs_three_calls_and_then_rests(error):
    waits, calls, now = [], [], [0.0]
    policy = RetryPolicy(sleep=waits.append, clock=lambda: now[0])
    rest = Rest(policy)

    def scorer(texts):
        calls.append(len(texts))
        raise error()

    assert call_scorer(scorer, ["a"] * 64, policy, rest) == [FALLBACK] * 64
    assert len(calls) == 3 and len(waits) == 2
    for _ in range(5):
        assert call_scorer(scorer, ["a"] * 64, policy, rest) == [FALLBACK] * 64
    assert len(calls) == 9
    now[0] = 61.0  # after the rest it is asked again
    assert call_scorer(lambda texts: [("LABEL_2", 1.0)] * len(texts), ["a"], policy, rest) == [("Positive", 1.0, None)]
    assert call_scorer(scorer, ["a"], policy, rest) == [FALLBACK] and len(calls) == 12


def test_halving_waits_no_more():
    waits, calls = [], []

    def scorer(texts):
        calls.append(len(texts))
        if "bad" in texts:
            raise ValueError
        return [("Positive", 1.0)] * len(texts)

    got = call_scorer(scorer, ["a", "b", "bad", "c"], RetryPolicy(sleep=waits.append))
    assert got == [("Positive", 1.0, None)] * 2 + [FALLBACK] + [("Positive", 1.0, None)]
    assert waits == [2, 4] and calls == [4, 4, 4, 2, 2, 1, 1]


def test_distinct_scoring_tasks(spark, folder):
    def factory():
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return lambda texts: [("Positive", 0.5)] * len(texts)

    df = posts(spark, [f"text {i}" for i in range(500)])
    assert score_distinct(df, factory, tasks=5).count() == 500
    assert len(os.listdir(folder)) == 5


def test_moving_input_invents_no_neutral(spark):
    df = posts(spark, ["x"] * 200).withColumn("cleaned_text", F.concat(F.lit("best "), F.expr("uuid()")))
    got = results(score_distinct(df, keyword_scorer, hot_share=0.5))
    assert set(got.values()) == {("Positive", 1.0, None)}


def test_native_keywords_equal_the_scorer(spark):
    df = posts(spark, ["best thing", "worst thing", "best worst", "plain", "", None, " ", "AMAZING fixes"])
    assert results(score_keywords(df)) == results(score(df, keyword_scorer))


def test_equal_texts_of_a_batch_are_asked_once():
    from moodlake.operators.scoring import _scoring_udf
    import pandas as pd

    asked = []

    def factory():
        def run(texts):
            asked.extend(texts)
            return [("Positive", 0.5)] * len(texts)
        return run

    run = _scoring_udf(factory, QUICK, 2).func
    [out] = run(iter([pd.Series(["a", "b", "a", None, "c", "a"])]))
    assert asked == ["a", "b", "c"]
    assert out.label.tolist()[:3] == ["Positive"] * 3 and out.label.isna().tolist() == [False] * 3 + [True] + [False] * 2


def test_calls_overlap_and_keep_their_order():
    import threading

    import pandas as pd
    from moodlake.operators.scoring import _scoring_udf

    together = threading.Barrier(4, timeout=20)

    def factory():
        def run(texts):
            together.wait()  # passes only when four calls are under way
            return [(t, 0.5) for t in texts]
        return run

    run = _scoring_udf(factory, RetryPolicy(attempts=1), 2, 4).func
    [out] = run(iter([pd.Series(list("abcdefgh"))]))
    assert out.label.tolist() == list("abcdefgh") and out.error.isna().all()


def test_scorer_runs_once_per_row_below_a_filter(spark):
    """A filter on the label must not make Spark evaluate the model a second time."""
    scored = score(posts(spark, ["best"] * 5), keyword_scorer).filter("sentiment_label = 'Positive'")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert scored.count() == 5


def test_scoring_shuffles_only_when_asked(spark):
    df = posts(spark, ["a", "b"])
    plans = [
        score(df, keyword_scorer, tasks=n)._jdf.queryExecution().executedPlan().toString() for n in (None, 3)
    ]
    assert "Exchange" not in plans[0] and "RoundRobinPartitioning(3)" in plans[1]


def test_keyword_scorer_equals_native_expression(spark):
    texts = ["best thing", "worst thing", "best worst", "best fix", "love poor", "plain", "AMAZING fixes", "the and"]
    df = posts(spark, texts)
    native = {r.id: r.s for r in df.select("id", keyword_sentiment("cleaned_text", "cleaned_text").alias("s")).collect()}
    assert {k: v[0] for k, v in results(score(df, keyword_scorer)).items()} == native


def test_distinct_scoring_with_a_hot_text(spark):
    """A third of all rows share one text; results equal row-wise scoring."""
    texts = ["best of all"] * 400 + ["", None, " "] * 40 + [f"poor {i % 300}" for i in range(680)]
    df = posts(spark, texts)
    for share in (1e-5, 0.001, 0.1, 1.0):
        got = results(score_distinct(df, keyword_scorer, hot_share=share))
        assert len(got) == len(texts) and got == results(score(df, keyword_scorer))
    with pytest.raises(ValueError):
        score_distinct(df, keyword_scorer, hot_share=0)


def test_distinct_scoring_of_identical_rows(spark):
    """Rows that differ in nothing keep their number."""
    df = spark.createDataFrame([("best",)] * 300 + [("poor",)] * 2 + [("",)] * 5, "cleaned_text string")
    for share in (1e-5, 0.5, 1.0):
        counts = score_distinct(df, keyword_scorer, hot_share=share).groupBy("sentiment_label").count().collect()
        assert dict(map(tuple, counts)) == {"Positive": 300, "Negative": 2, "Neutral": 5}


def test_distinct_scoring_asks_once_per_text(spark, folder):
    log = folder + "/asked"

    def factory():
        def run(texts):
            with open(log, "a") as f:
                f.writelines(t + "\n" for t in texts)
            return [("Positive", 0.5)] * len(texts)
        return run

    df = posts(spark, [f"text {i % 10}" for i in range(500)]).repartition(4)
    scored = score_distinct(df, factory)
    assert scored.count() == 500 and scored.filter("sentiment_label = 'Positive'").count() == 500
    assert sorted(open(log).read().split("\n")[:-1]) == [f"text {i}" for i in range(10)]


def test_distinct_scoring_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, cleaned_text string")
    assert score_distinct(empty, keyword_scorer).count() == 0


def test_given_scores(spark):
    df = spark.createDataFrame(
        [(0, "a", "LABEL_2", 0.5, None), (1, "a", "Other", 0.5, None), (2, "", "LABEL_2", 0.5, None),
         (3, "a", "LABEL_2", 0.5, "boom"), (4, "a", None, None, None), (5, "a", "", 0.5, None)],
        "id int, cleaned_text string, l string, s double, e string",
    )
    assert results(score_columns(df, "l", "s", "e")) == {
        0: ("Positive", 0.5, None), 1: ("Other", 0.5, None), 2: ("Neutral", 0.0, "empty_text"),
        3: FALLBACK, 4: FALLBACK, 5: ("Neutral", 0.5, None),
    }
    answers = df.select("id", "cleaned_text", F.lit('[[{"label":"LABEL_0","score":0.9}]]').alias("r"))
    assert results(score_responses(answers, "r"))[0] == ("Negative", 0.9, None)
