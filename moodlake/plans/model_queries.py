"""Evaluation reports and the classifier."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from moodlake.functions.predictions import LABELS
from moodlake.functions.text import clean_text
from moodlake.operators import classifier, evaluation
from moodlake.operators.split import hash_split
from moodlake.plans.posts_view import LABELLED_SQL, labelled, labelled_from, spread_posts, table
from moodlake.plans.registry import query
from moodlake.plans.text_queries import IDF_SQL, words_sql
from moodlake.session import scratch_table

_PAIR = ("sentiment_label", "model_label")


@query(
    "label_index",
    f"""WITH {LABELLED_SQL}, c AS (SELECT sentiment_label, count(*) AS n FROM labelled GROUP BY 1)
    SELECT sentiment_label, n, (row_number() OVER (ORDER BY n DESC, sentiment_label) - 1)::DOUBLE AS index FROM c""",
)
def _(spark, sf_dir):
    return classifier.label_index(labelled(spark, sf_dir))


@query(
    "confusion_matrix",
    f"""WITH {LABELLED_SQL} SELECT sentiment_label AS actual,
      """ + ", ".join(f'count(*) FILTER (model_label = \'{v}\') AS "{v}"' for v in LABELS)
    + " FROM labelled GROUP BY 1",
)
def _(spark, sf_dir):
    return evaluation.confusion_matrix(labelled(spark, sf_dir), *_PAIR, classes=list(LABELS))


_REPORT_SQL = f"""WITH {LABELLED_SQL},
    support AS (SELECT sentiment_label AS class, count(*) AS support,
      count(*) FILTER (sentiment_label = model_label) AS tp FROM labelled GROUP BY 1),
    guessed AS (SELECT model_label AS class, count(*) AS guessed FROM labelled GROUP BY 1),
    pr AS (SELECT class, support, CASE WHEN guessed > 0 THEN tp / guessed::DOUBLE ELSE 0 END AS precision,
      tp / support::DOUBLE AS recall, tp FROM support LEFT JOIN guessed USING (class)),
    report AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
      ELSE 0 END AS f1 FROM pr)"""


@query(
    "per_class_report",
    f"""{_REPORT_SQL} SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1 FROM report""",
)
def _(spark, sf_dir):
    report = evaluation.class_report(labelled(spark, sf_dir), *_PAIR)
    return report.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "weighted_metrics",
    f"""{_REPORT_SQL} SELECT round(sum(tp) / sum(support), 6) AS accuracy,
      round(sum(support * precision) / sum(support), 6) AS weighted_precision,
      round(sum(support * recall) / sum(support), 6) AS weighted_recall,
      round(sum(support * f1) / sum(support), 6) AS f1 FROM report""",
)
def _(spark, sf_dir):
    return evaluation.weighted_metrics(labelled(spark, sf_dir), *_PAIR)


@query(
    "evaluator_metrics",
    f"""{_REPORT_SQL} SELECT round(sum(tp) / sum(support), 6) AS accuracy,
      round(sum(support * precision) / sum(support), 6) AS "weightedPrecision",
      round(sum(support * recall) / sum(support), 6) AS "weightedRecall",
      round(sum(support * f1) / sum(support), 6) AS f1 FROM report""",
)
def _(spark, sf_dir):
    """The ML evaluator over the confusion counts, weighted by their rows."""
    names = F.array(*map(F.lit, LABELS))
    counts = evaluation.confusion_counts(labelled(spark, sf_dir), *_PAIR).select(
        F.array_position(names, F.col("actual")).cast("double").alias("label"),
        F.array_position(names, F.col("predicted")).cast("double").alias("prediction"),
        F.col("n").cast("double").alias("n"),
    )
    return spark.createDataFrame([evaluation.evaluator_metrics(counts, weight="n")])


@query(
    "hashed_term_weights",
    words_sql(
        f"{LABELLED_SQL}, texts AS (SELECT id AS row, cleaned_text FROM labelled)", f"round(count(*) * {IDF_SQL}, 3) AS weight"
    ),
)
def _(spark, sf_dir):
    """Counts and IDF weights per hash bucket; the posts' few terms share none."""
    totals = classifier.bucket_totals(classifier.vectorise(labelled(spark, sf_dir)))
    return totals.withColumn("weight", F.round("weight", 3))


@query(
    "scorer_agreement",
    f"""WITH {LABELLED_SQL} SELECT count(*) AS n, count(*) FILTER (sentiment_label = model_label) AS agreeing,
      round(100.0::DOUBLE * count(*) FILTER (sentiment_label = model_label) / count(*), 6) AS agreement_pct FROM labelled""",
)
def _(spark, sf_dir):
    return evaluation.agreement(labelled(spark, sf_dir), *_PAIR)


_MODELS: dict[tuple[str, str], PipelineModel] = {}


def stored_labelled(spark, sf_dir):
    """Labelled posts, cleaned once and in many tasks, for jobs that split and read them several times."""
    rows = labelled_from(spread_posts(spark, sf_dir)).select("id", "cleaned_text", "sentiment_label", "inference_error")
    return scratch_table(rows, "labelled")


def _fitted(spark, sf_dir, rows) -> PipelineModel:
    """The classifier fitted on the train side of all posts, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key], _seconds = classifier.fit_classifier(hash_split(rows)[0])
    return _MODELS[key]


@query("train_predict")
def train_predict(spark, sf_dir):
    """Predictions for the test side."""
    rows = stored_labelled(spark, sf_dir)
    _train, test = hash_split(rows)
    predictions = classifier.predict(_fitted(spark, sf_dir, rows), test)
    return predictions.select("id", "sentiment_label", "predicted_label", "prediction")


@query("train_evaluate")
def _(spark, sf_dir):
    """Per-class report of the classifier on the test side."""
    rows = stored_labelled(spark, sf_dir)
    model = _fitted(spark, sf_dir, rows)
    _train, test = hash_split(rows)
    predictions = classifier.predict(model, classifier.known_labels_only(test, model))
    return evaluation.class_report(predictions, "sentiment_label", "predicted_label", include_unseen=True)


@query("local_model_scoring")
def _(spark, sf_dir):
    """The fitted model scores all posts in the remote model's place."""
    rows = stored_labelled(spark, sf_dir)
    scored = classifier.score_with_model(_fitted(spark, sf_dir, rows), rows.select("id", "cleaned_text"))
    return scored.select("id", "sentiment_label", "confidence_score", "inference_error")


@query("train_quality")
def _(spark, sf_dir):
    """The same classifier on real-length text: document quality from labelled documents."""
    rows = (
        table(spark, sf_dir, "documents").select("doc_id", "text")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .select("doc_id", clean_text("text").alias("cleaned_text"), F.col("quality").cast("string").alias("quality"))
    )
    train, test = hash_split(rows, "doc_id")
    model, _seconds = classifier.fit_classifier(train, label="quality")
    predictions = classifier.predict(model, classifier.known_labels_only(test, model, "quality"))
    return evaluation.class_report(predictions, "quality", "predicted_label", include_unseen=True)
