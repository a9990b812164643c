"""Classification reports from one pass over (actual, predicted) pairs.

Every report starts from the confusion counts: at most K x K rows for K
classes, however many rows were counted.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, functions as F

EVALUATOR_METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")


def confusion_counts(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, actual: str = "label", predicted: str = "prediction", classes: list | None = None
) -> DataFrame:
    """One row per actual class, one column per predicted class, 0 where none.

    Naming the classes saves Spark the extra job that looks for them.
    """
    return (
        confusion_counts(df, actual, predicted)
        .groupBy("actual").pivot("predicted", classes).agg(F.sum("n"))
        .na.fill(0).orderBy("actual")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(
    df: DataFrame, actual: str = "label", predicted: str = "prediction", include_unseen: bool = False
) -> DataFrame:
    """Support, precision, recall and F1 per class; 0.0 on an empty denominator.

    ``include_unseen`` adds classes that were predicted but never true.
    """
    hit = F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("actual").alias("class"), F.col("n").alias("support"), zero.alias("guessed"),
            hit.cast("bigint").alias("tp"),
        ),
        F.struct(
            F.col("predicted").alias("class"), zero.alias("support"), F.col("n").alias("guessed"), zero.alias("tp"),
        ),
    )
    sums = (
        confusion_counts(df, actual, predicted).select(F.inline(sides))
        .groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "tp")])
    )
    if not include_unseen:
        sums = sums.filter(F.col("support") > 0)
    precision, recall = F.col("precision"), F.col("recall")
    return (
        sums.withColumns({
            "precision": _ratio(F.col("tp"), F.col("guessed")),
            "recall": _ratio(F.col("tp"), F.col("support")),
        })
        .withColumn("f1", _ratio(2 * precision * recall, precision + recall))
        .select("class", "support", "precision", "recall", "f1", "tp")
    )


def weighted_metrics(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """Accuracy and class-share weighted precision, recall and F1 as one row, 6 decimals."""
    report = class_report(df, actual, predicted)
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return F.round(F.sum(F.col("support") * F.col(name)) / total, 6)

    return report.agg(
        F.round(F.sum("tp") / total, 6).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("f1"),
    )


def evaluator_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> dict[str, float]:
    """The same four figures from Spark ML's evaluator; -1.0 where it fails.

    It passes over its input once per figure. Given confusion counts and
    ``weight="n"`` that is a handful of rows, with the same result.
    """
    out = {}
    for name in EVALUATOR_METRICS:
        evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=name)
        if weight:
            evaluator.setWeightCol(weight)
        try:
            out[name] = round(evaluator.evaluate(predictions), 6)
        except Exception:  # an undefined metric must not lose the other three
            out[name] = -1.0
    return out


def agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """How often two scorers of the same rows agree, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(first).eqNullSafe(F.col(second))).alias("agreeing"),
    ).withColumn("agreement_pct", F.round(F.try_divide(100.0 * F.col("agreeing"), F.col("n")), 6))
