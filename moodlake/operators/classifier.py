"""Train, apply, save and load the text classifier."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, IDF, IndexToString, StringIndexer, StringIndexerModel, Tokenizer, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from moodlake.functions.predictions import EMPTY_TEXT, unscored
from moodlake.functions.text import is_blank
from moodlake.session import scratch_scope, scratch_table, spread
from moodlake.operators.scoring import with_score


# Slicing a vector takes time in proportion to the buckets kept; beyond this it costs more than it saves.
MOST_SLICED = 2048


@dataclass(frozen=True)
class ClassifierParams:
    features: int = 65536
    max_iter: int = 100
    reg_param: float = 0.01
    elastic_net: float = 0.5
    # "error" is safe because training rows without a label are left out first.
    # "keep" would reserve a class for unseen labels, which the regression then
    # fits as one class too many.
    handle_invalid: str = "error"
    # Raise for thousands of partitions: gradients are then added up in more steps.
    aggregation_depth: int = 2


def _feature_stages(params: ClassifierParams, text: str) -> list:
    return [
        Tokenizer(inputCol=text, outputCol="tokens"),
        HashingTF(inputCol="tokens", outputCol="raw_features", numFeatures=params.features),
        IDF(inputCol="raw_features", outputCol="features"),
    ]


def vectorise(
    df: DataFrame, params: ClassifierParams = ClassifierParams(), text: str = "cleaned_text"
) -> DataFrame:
    """Add tokens, hashed counts (``raw_features``) and IDF weights (``features``)."""
    return Pipeline(stages=_feature_stages(params, text)).fit(df).transform(df)


def bucket_totals(vectors: DataFrame) -> DataFrame:
    """tf, df and total weight per bucket that occurs, from vectorised rows."""
    sums = vectors.agg(
        Summarizer.sum(F.col("raw_features")).alias("tf"),
        Summarizer.numNonZeros(F.col("raw_features")).alias("df"),
        Summarizer.sum(F.col("features")).alias("weight"),
    )
    arrays = [vector_to_array(c).alias(c) for c in sums.columns]
    zipped = sums.select(*arrays).select(F.inline(F.arrays_zip("tf", "df", "weight")))
    return zipped.filter("tf > 0").select(F.col("tf").cast("bigint"), F.col("df").cast("bigint"), "weight")


def build_pipeline(
    params: ClassifierParams = ClassifierParams(), text: str = "cleaned_text", label: str = "sentiment_label"
) -> Pipeline:
    """Tokens -> hashed counts -> IDF weights; label -> index; logistic regression."""
    return Pipeline(stages=[
        *_feature_stages(params, text),
        StringIndexer(inputCol=label, outputCol="label", handleInvalid=params.handle_invalid),
        LogisticRegression(
            featuresCol="features", labelCol="label", family="multinomial",
            maxIter=params.max_iter, regParam=params.reg_param, elasticNetParam=params.elastic_net,
            aggregationDepth=params.aggregation_depth,
        ),
    ])


def trainable(df: DataFrame, text: str = "cleaned_text", label: str = "sentiment_label") -> DataFrame:
    """Text and label of rows fit to learn from: both present, and scored without
    error where ``inference_error`` is known (a fallback Neutral teaches nothing)."""
    keep = F.col(text).isNotNull() & (F.coalesce(label, F.lit("")) != "")
    if "inference_error" in df.columns:
        keep = keep & F.col("inference_error").isNull()
    return df.filter(keep).select(text, label)


def _fit(rows: DataFrame, params: ClassifierParams, text: str, label: str) -> PipelineModel:
    """The stages of ``build_pipeline`` fitted one after the other, the regression on the buckets that occur.

    Each evaluation of the loss sends a gradient of classes x buckets to the driver, and the optimiser's L1 step walks over
    all of them. A bucket that no training row has varies nowhere, so its coefficients are zero in any case: leaving it out
    gives the same model. Its stage is then the IDF followed by a slicer.
    """
    tokens, counts, idf, index, regression = build_pipeline(params, text, label).getStages()
    counted = PipelineModel([tokens, counts]).transform(rows)
    weights = idf.fit(counted)
    occurring = [i for i, n in enumerate(weights.docFreq) if n]
    if len(occurring) <= min(MOST_SLICED, params.features // 2):
        slicer = VectorSlicer(inputCol="all_features", outputCol=idf.getOutputCol(), indices=occurring)
        weights = PipelineModel([weights.setOutputCol("all_features"), slicer])
    rest = Pipeline(stages=[index, regression]).fit(weights.transform(counted))
    return PipelineModel([tokens, counts, weights, *rest.stages])


def fit_classifier(
    df: DataFrame,
    params: ClassifierParams = ClassifierParams(),
    text: str = "cleaned_text",
    label: str = "sentiment_label",
) -> tuple[PipelineModel, float]:
    """The fitted model and the seconds it took.

    Three stages read the rows. Text and label are stored once in the shared scratch folder, in files for all
    cores, so that the source is read and cleaned once, and removed when the model is there.
    """
    started = time.monotonic()
    with scratch_scope(df.sparkSession):
        rows = scratch_table(spread(trainable(df, text, label)), "training")
        model = _fit(rows, params, text, label)
    return model, time.monotonic() - started


def _indexer(model: PipelineModel) -> StringIndexerModel:
    return next(stage for stage in model.stages if isinstance(stage, StringIndexerModel))


def labels(model: PipelineModel) -> list[str]:
    """The labels in the order of their indices."""
    return list(_indexer(model).labels)


def predict(model: PipelineModel, df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """Every row of a table or stream with ``probability``, ``prediction`` and
    ``predicted_label``.

    The true label takes no part: its column is set aside under another name,
    so rows with a missing or unseen label are predicted like any other. NULL
    text is predicted as empty text.
    """
    indexer = _indexer(model)
    label = indexer.getInputCol()
    aside = f"_{label}"
    kept = df.withColumnRenamed(label, aside).withColumn(text, F.coalesce(text, F.lit("")))
    out = IndexToString(
        inputCol="prediction", outputCol="predicted_label", labels=indexer.labels
    ).transform(model.transform(kept))
    return out.withColumnRenamed(aside, label)


def score_with_model(model: PipelineModel, df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """The trained model in the scorer's place: sentiment_label, confidence_score,
    inference_error. Runs in the JVM, on batch and stream."""
    kept = [c for c in df.columns if c != "sentiment_label"]
    predicted = predict(model, df.select(*kept), text)
    given = F.struct(
        F.col("predicted_label").alias("label"),
        F.array_max(vector_to_array("probability")).cast("float").alias("score"),
        F.lit(None).cast("string").alias("error"),
    )
    result = F.when(is_blank(text), unscored(EMPTY_TEXT)).otherwise(given)
    return with_score(predicted.select(*kept, result.alias("_given")), F.col("_given")).drop("_given")


def known_labels_only(df: DataFrame, model: PipelineModel, label: str = "sentiment_label") -> DataFrame:
    """Rows whose true label the model knows, for evaluation."""
    return df.filter(F.col(label).isin(*_indexer(model).labels))


def indexed(predictions: DataFrame, model: PipelineModel, label: str = "sentiment_label") -> DataFrame:
    """Add the true label's index as ``label``, as the ML evaluator wants it."""
    return _indexer(model).setOutputCol("label").transform(known_labels_only(predictions, model, label))


def label_index(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """label, n, index in the indexer's order: most frequent first, ties by name.

    The window runs over one row per label, after the aggregation.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), label))
    return counts.withColumn("index", (place - 1).cast("double"))


def save(model: PipelineModel, pipeline_path: str, regression_path: str | None = None) -> None:
    """Save the whole pipeline and, if asked, the regression alone; overwrites."""
    model.write().overwrite().save(pipeline_path)
    if regression_path:
        regression = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
        regression.write().overwrite().save(regression_path)


def load(pipeline_path: str) -> PipelineModel:
    return PipelineModel.load(pipeline_path)
