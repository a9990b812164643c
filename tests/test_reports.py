from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moodlake.functions import display
from moodlake.operators import evaluation, metrics, search, terms, trend
from moodlake.operators.split import hash_split, split_bucket

PAIRS = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(float(a), float(p)) for a, p in PAIRS], "label double, prediction double")


def report(df, **options):
    return {
        r["class"]: (r.support, round(r.precision, 6), round(r.recall, 6), round(r.f1, 6))
        for r in evaluation.class_report(df, **options).collect()
    }


def test_class_report(pairs):
    assert report(pairs) == {0: (3, 1, 0.666667, 0.8), 1: (2, 0.5, 0.5, 0.5), 2: (1, 0.5, 1, 0.666667)}


def test_classes_never_predicted_or_never_true(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b")], "label string, prediction string")
    assert report(df) == {"a": (2, 0, 0, 0)}
    assert report(df, include_unseen=True) == {"a": (2, 0, 0, 0), "b": (0, 0, 0, 0)}


def test_weighted_metrics_equal_evaluator(pairs):
    row = evaluation.weighted_metrics(pairs).first()
    assert tuple(row) == (0.666667, 0.75, 0.666667, 0.677778)
    assert tuple(evaluation.evaluator_metrics(pairs).values()) == tuple(row)
    counts = evaluation.confusion_counts(pairs).selectExpr(
        "actual AS label", "predicted AS prediction", "CAST(n AS DOUBLE) AS n"
    )
    assert tuple(evaluation.evaluator_metrics(counts, weight="n").values()) == tuple(row)
    assert evaluation.evaluator_metrics(pairs.withColumnRenamed("label", "other"))["accuracy"] == -1.0


def test_confusion_matrix(pairs):
    rows = [tuple(r) for r in evaluation.confusion_matrix(pairs, classes=[0.0, 1.0, 2.0]).collect()]
    assert rows == [(0.0, 2, 1, 0), (1.0, 0, 1, 1), (2.0, 0, 0, 1)]
    assert sum(sum(r[1:]) for r in rows) == len(PAIRS)
    assert evaluation.confusion_matrix(pairs).count() == 3


def test_agreement(pairs):
    assert tuple(evaluation.agreement(pairs, "label", "prediction").first()) == (6, 4, 66.666667)
    assert evaluation.agreement(pairs.filter("false"), "label", "prediction").first().agreement_pct is None


@pytest.fixture
def scored(spark):
    start = datetime(2024, 1, 1)
    labels = ["Positive"] * 5 + ["Negative"] * 3 + ["Neutral"] * 2
    rows = [
        (str(i), start + timedelta(hours=6 * i), f"Text {i} naïve", f"text {i} na ve", label, 0.5 + i / 100, None)
        for i, label in enumerate(labels)
    ]
    return spark.createDataFrame(
        rows, "id string, timestamp timestamp, original_text string, cleaned_text string, sentiment_label string,"
        " confidence_score double, inference_error string",
    )


def test_mixes(scored):
    assert [tuple(r) for r in metrics.class_distribution(scored).collect()] == [
        ("Positive", 5), ("Negative", 3), ("Neutral", 2),
    ]
    shares = {r.sentiment_label: r.share_pct for r in metrics.mix(scored).collect()}
    assert shares == {"Positive": 50.0, "Negative": 30.0, "Neutral": 20.0}
    row = metrics.mix_row(scored).first()
    assert (row.positive_pct, row.negative_pct, row.neutral_pct, row.neutral_n) == (50.0, 30.0, 20.0, 2)
    assert metrics.mix_row(scored.filter("false")).first().positive_pct == 0.0


def test_mix_scans_once(spark, scored, folder):
    scored.write.parquet(folder + "/t")
    mixed = metrics.mix(spark.read.parquet(folder + "/t"), "id")
    assert {r.share_pct for r in mixed.collect()} == {10.0}
    plan = mixed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and "Window" not in plan


def test_kpis(scored):
    row = metrics.kpi_summary(scored).first()
    assert (row.total, row.mean_confidence_pct, row.alerts, row.positive_pct) == (10, 54.5, 0, 50.0)
    assert row.posts_per_second == round(10 / (54 * 3600), 6)
    empty = metrics.kpi_summary(scored.filter("false")).first()
    assert (empty.total, empty.mean_confidence_pct, empty.posts_per_second) == (0, None, None)
    assert metrics.kpi_summary(scored.limit(1)).first().posts_per_second is None


def test_throughput_and_failures(scored):
    rows = metrics.throughput(scored, "1 day").orderBy("window_start").collect()
    assert [r.n for r in rows] == [4, 4, 2] and rows[0].posts_per_second == round(4 / 86400, 6)
    failed = scored.withColumn("inference_error", F.when(F.col("id") < "2", "api_unavailable"))
    assert {r.inference_error: r.n for r in metrics.failure_rate(failed).collect()} == {"none": 8, "api_unavailable": 2}


def test_trend(scored):
    points = trend.sentiment_trend(scored)
    rows = points.orderBy("window_start").collect()
    assert [(r.n, r.positive_pct, r.neutral_pct, r.negative_pct) for r in rows] == [
        (4, 100.0, 0.0, 0.0), (4, 25.0, 0.0, 75.0), (2, 0.0, 100.0, 0.0),
    ]
    # 2024-01-01 is day 19723 of the epoch, so the 3rd is the first multiple of three.
    assert [r.window_start.day for r in trend.sampled_trend(points).collect()] == [3]
    hourly = trend.sentiment_trend(scored, "6 hours")
    last = trend.last_points(hourly, "Day").collect()
    assert len(last) == 7 and [r.window_start for r in last] == sorted(r.window_start for r in last)
    assert trend.last_points(hourly, "Month").count() == 10


def test_trend_counts_foreign_labels_only_in_n(scored):
    odd = scored.withColumn("sentiment_label", F.lit("Other"))
    row = trend.sentiment_trend(odd, "100 days").first()
    assert (row.n, row.positive_pct, row.neutral_pct) == (10, 0.0, 0.0)


def test_feed_is_a_top_k(scored):
    feed = trend.recent_feed(scored)
    assert [r.id for r in feed.collect()] == ["9", "8", "7", "6", "5", "4", "3"]
    assert "TakeOrderedAndProject" in feed._jdf.queryExecution().executedPlan().toString()


def test_shuffles_follow_partial_counts(scored):
    """One exchange per report, and only of counted rows."""
    for df in (trend.sentiment_trend(scored), metrics.mix_row(scored), metrics.kpi_summary(scored),
               evaluation.confusion_counts(scored, "sentiment_label", "sentiment_label")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert "partial_count" in plan.split("Exchange")[1]


def test_search(scored):
    assert search.text_search(scored, "naïve").count() == 10
    assert search.text_search(scored, "na ve").count() == 10
    assert search.text_search(scored, r"^text [0-3]", regex=True).count() == 4
    assert search.text_search(scored, "none such").count() == 0
    assert search.label_count(scored).first().n == 5
    as_of = F.lit("2024-01-03 06:00:00").cast("timestamp")
    rows = {r.sentiment_label: r.n for r in search.term_mix(scored, "text", as_of, hours=12).collect()}
    assert rows == {"Neutral": 2}


def test_split(spark):
    df = spark.createDataFrame([(str(i),) for i in range(2000)] + [(None,)], "id string")
    train, test = hash_split(df)
    assert train.count() + test.count() == 2001 and 1520 < train.count() < 1680
    assert hash_split(df.repartition(7))[0].exceptAll(train).isEmpty()
    import hashlib
    want = int(hashlib.md5(b"17").hexdigest()[:8], 16) % 100
    assert df.filter("id = '17'").select(split_bucket("id").alias("b")).first().b == want


def test_term_stats_against_brute_force(spark):
    import math
    from collections import Counter

    texts = ["a b a", " b", "c", None, "", "a  c c c"]
    lists = [t.rstrip().split(" ") for t in texts if t is not None]
    tf, df = Counter(w for ws in lists for w in ws), Counter(w for ws in lists for w in set(ws))
    rows = spark.createDataFrame([(t,) for t in texts], "cleaned_text string")
    got = {r.term: (r.tf, r.df, round(r.idf, 9)) for r in terms.term_stats(rows).collect()}
    assert got == {w: (tf[w], df[w], round(math.log(6 / (df[w] + 1)), 9)) for w in tf}


def test_display(evaluate):
    assert evaluate(display.thousands, [1234567, 0], "long") == ["1,234,567", "0"]
    assert evaluate(display.percent, [12.34, 100.0], "double") == ["12.3%", "100.0%"]
    assert evaluate(display.alert_badge, [0, 799, 800, 81730, 10**9], "long") == [0, 0, 1, 99, 99]
    assert evaluate(lambda c: display.clock(F.col(c).cast("timestamp")), ["2024-01-02 23:04:05"]) == ["23:04:05"]
