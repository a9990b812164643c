import os
import uuid

import pytest

from moodlake.operators.scoring import RetryPolicy, score_distinct
from moodlake.sources import answers, commits


@pytest.fixture
def asked(folder):
    """A scorer factory that notes every text it is asked about, and what it was asked since the last look."""
    os.makedirs(folder + "/asked")

    def factory():
        def run(texts):
            with open(f"{folder}/asked/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(texts))
            if any("broken" in t for t in texts):
                raise OSError("no service")
            return [("Positive", len(t) / 100) for t in texts]
        return run

    def since():
        names = os.listdir(folder + "/asked")
        found = sorted(t for n in names for t in open(f"{folder}/asked/{n}").read().split("\n"))
        for n in names:
            os.remove(f"{folder}/asked/{n}")
        return found

    return factory, since


def scored(spark, folder, factory, *texts, **settings):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, cleaned_text string")
    quick = RetryPolicy(attempts=1, sleep=lambda seconds: None)
    out = score_distinct(df, factory, retry=quick, call_size=1, remember=folder + "/answers", **settings)
    return {r.id: (r.sentiment_label, round(r.confidence_score, 4), r.inference_error) for r in out.collect()}


def test_a_text_of_an_earlier_batch_is_not_asked_about(spark, folder, asked):
    factory, since = asked
    first = scored(spark, folder, factory, "one", "two two", "one", None, " ")
    assert since() == ["one", "two two"]
    assert first == {0: ("Positive", 0.03, None), 1: ("Positive", 0.07, None), 2: ("Positive", 0.03, None), 3: ("Neutral", 0.0, "empty_text"), 4: ("Neutral", 0.0, "empty_text")}
    second = scored(spark, folder, factory, "two two", "three", "one")
    assert since() == ["three"]
    assert second == {0: first[1], 1: ("Positive", 0.05, None), 2: first[0]}
    assert scored(spark, folder, factory, "three", "two two") == {0: second[1], 1: first[1]} and since() == []
    assert answers.read_answers(spark, folder + "/answers").count() == 3


def test_failures_are_not_remembered(spark, folder, asked):
    factory, since = asked
    assert scored(spark, folder, factory, "broken")[0] == ("Neutral", 0.0, "api_unavailable")
    assert scored(spark, folder, factory, "broken", "fine")[1][2] is None
    assert since() == ["broken", "broken", "fine"]
    assert answers.read_answers(spark, folder + "/answers").count() == 1


def test_folding_and_pruning(spark, folder, asked):
    factory, since = asked
    path = folder + "/answers"
    assert answers.read_answers(spark, path).count() == 0 and answers.fold(spark, path) is None
    for k in range(3):
        scored(spark, folder, factory, *[f"text {i}" for i in range(10 * k, 10 * k + 12)])
    since()
    before = sorted(map(str, answers.read_answers(spark, path).collect()))
    answers.fold(spark, path)
    assert sorted(map(str, answers.read_answers(spark, path).collect())) == before and len(before) == 32
    assert len(commits.read_state(spark, path).live) == 1
    assert scored(spark, folder, factory, "text 3", "text 31")[1][0] == "Positive" and since() == []
    table = answers.read_answers(spark, path)
    one = table.first().bucket
    assert 0 < len(table.filter(table.bucket == one).inputFiles()) <= len(table.inputFiles())
    plan = table.filter(table.bucket == one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
