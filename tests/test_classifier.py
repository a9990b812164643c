import math

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import HashingTF, IDF, StringIndexer, Tokenizer
from pyspark.sql import functions as F

from moodlake.operators import classifier, evaluation

SMALL = classifier.ClassifierParams(features=256, max_iter=20)
TEXTS = [("love this best day", "Positive"), ("terrible broken waste", "Negative"), ("it arrived on tuesday", "Neutral")]


@pytest.fixture(scope="module")
def data(spark):
    rows = [(str(i), *TEXTS[i % 3], None) for i in range(60)]
    rows += [(str(i), *TEXTS[0], None) for i in range(60, 66)]
    rows += [("x", "never seen", "Odd", "api_unavailable"), ("y", "love this", None, None), ("z", "best day", "", None)]
    return spark.createDataFrame(rows, "id string, cleaned_text string, sentiment_label string, inference_error string")


@pytest.fixture(scope="module")
def model(data):
    fitted, seconds = classifier.fit_classifier(data, SMALL)
    assert seconds > 0
    return fitted


def test_fits_only_clean_rows(data, model):
    assert classifier.trainable(data).count() == 66
    assert model.stages[3].labels == ["Positive", "Negative", "Neutral"]
    assert model.stages[4].numClasses == 3


def test_predicts_every_row(data, model):
    rows = {r.id: r for r in classifier.predict(model, data).collect()}
    assert len(rows) == 69
    assert rows["y"].predicted_label == "Positive" and rows["x"].sentiment_label == "Odd"
    assert all(rows[str(i)].predicted_label == TEXTS[i % 3][1] for i in range(60))


def test_evaluation_agrees_with_the_ml_evaluator(data, model):
    predictions = classifier.predict(model, data)
    known = classifier.known_labels_only(predictions, model)
    assert known.count() == 66
    ours = evaluation.weighted_metrics(known, "sentiment_label", "predicted_label").first()
    theirs = evaluation.evaluator_metrics(classifier.indexed(predictions, model))
    assert tuple(ours) == tuple(theirs.values())


def test_scoring_with_the_model(spark, data, model):
    df = spark.createDataFrame([("1", "love best"), ("2", " "), ("3", None)], "id string, cleaned_text string")
    rows = {r.id: r for r in classifier.score_with_model(model, df).collect()}
    assert rows["1"].sentiment_label == "Positive" and rows["1"].confidence_score > 0.5
    assert rows["2"].inference_error == rows["3"].inference_error == "empty_text"


def test_save_and_load(folder, data, model):
    classifier.save(model, folder + "/all", folder + "/regression")
    classifier.save(model, folder + "/all", folder + "/regression")  # overwrites
    again = classifier.load(folder + "/all")
    before, after = (classifier.predict(m, data).select("id", "prediction") for m in (model, again))
    assert before.exceptAll(after).isEmpty()
    assert LogisticRegressionModel.load(folder + "/regression").numClasses == 3


def test_defaults_and_stages():
    params = classifier.ClassifierParams()
    stages = classifier.build_pipeline().getStages()
    assert [type(s).__name__ for s in stages] == ["Tokenizer", "HashingTF", "IDF", "StringIndexer", "LogisticRegression"]
    regression = stages[4]
    assert (stages[1].getNumFeatures(), regression.getMaxIter(), regression.getRegParam(), regression.getElasticNetParam()) == (
        65536, 100, 0.01, 0.5
    )
    assert params.handle_invalid == stages[3].getHandleInvalid() == "error"


def test_idf_formula_and_hashed_counts(spark):
    df = spark.createDataFrame([("a b",), ("a",), ("a a c",)], "cleaned_text string")
    counted = HashingTF(inputCol="t", outputCol="f", numFeatures=65536).transform(
        Tokenizer(inputCol="cleaned_text", outputCol="t").transform(df)
    )
    assert sorted(sum(r.f.values) for r in counted.collect()) == [1.0, 2.0, 3.0]
    hashing = HashingTF(inputCol="t", outputCol="f", numFeatures=65536)
    idf = IDF(inputCol="f", outputCol="w").fit(counted).idf
    assert idf[hashing.indexOf("a")] == pytest.approx(math.log(4 / 4))
    assert idf[hashing.indexOf("c")] == pytest.approx(math.log(4 / 2))


def test_label_index_matches_the_indexer(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacd"] + [(None,)], "sentiment_label string")
    got = {r.sentiment_label: r["index"] for r in classifier.label_index(df).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}
    assert StringIndexer(inputCol="sentiment_label", outputCol="i", handleInvalid="skip").fit(df).labels == list("abcd")


def test_buckets_that_never_occur_are_left_out_of_the_regression(spark, data, model):
    """Each gradient sent to the driver is classes x buckets; the model is the one fitted on all of them."""
    assert model.stages[4].numFeatures == len({word for text, _label in TEXTS for word in text.split()})
    rows = classifier.trainable(data)
    whole = classifier.build_pipeline(SMALL).fit(rows)
    assert whole.stages[4].numFeatures == SMALL.features
    new = spark.createDataFrame([("love waste tuesday",), ("none of these",), ("",)], "cleaned_text string").withColumn("sentiment_label", F.lit("?"))
    probed = rows.distinct().unionByName(new)
    ours, theirs = ({r.cleaned_text: r.probability for r in classifier.predict(m, probed).collect()} for m in (model, whole))
    assert len(ours) == 6
    assert all(ours[text].toArray() == pytest.approx(theirs[text].toArray(), abs=1e-9) for text in ours)


def test_many_buckets_are_not_sliced(spark, monkeypatch, data):
    monkeypatch.setattr(classifier, "MOST_SLICED", 3)
    fitted, _seconds = classifier.fit_classifier(data, SMALL)
    assert fitted.stages[4].numFeatures == SMALL.features


def test_training_rows_of_one_file_are_read_by_several_tasks(spark, folder, data, monkeypatch):
    data.coalesce(1).write.parquet(folder + "/one")
    parts, fit = [], classifier._fit
    monkeypatch.setattr(classifier, "_fit", lambda rows, *rest: parts.append(rows.rdd.getNumPartitions()) or fit(rows, *rest))
    classifier.fit_classifier(spark.read.parquet(folder + "/one"), SMALL)
    assert parts[0] > 1


def test_posts_for_training_are_cleaned_once_and_in_several_tasks(spark):
    from moodlake.plans.model_queries import stored_labelled
    from moodlake.plans.posts_view import labelled

    rows, plain = stored_labelled(spark, "/root/testdata/sf0.001"), labelled(spark, "/root/testdata/sf0.001")
    assert len(rows.inputFiles()) > 1
    assert rows.exceptAll(plain.select(*rows.columns)).isEmpty() and rows.count() == plain.count()
    assert "regexp_replace" not in rows.filter("sentiment_label <> ''")._jdf.queryExecution().toString()
