"""Rows that go wrong, calls that fail first, and a classifier whose answers can be foretold."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake.functions.payload import parse_score
from moodlake.functions.predictions import default_label
from moodlake.operators import classifier, evaluation
from moodlake.operators.ingest import reject_counts, tag_rejects, validate
from moodlake.operators.posts import clean_posts, stored_shape
from moodlake.operators.scoring import RateLimited, RetryPolicy, keyword_scorer, score
from moodlake.operators.split import hash_split
from moodlake.plans.ingest_queries import _STRIPPED, _raw, _write_csv
from moodlake.plans.model_queries import stored_labelled
from moodlake.plans.posts_view import LABELLED_SQL, POSTS_SQL, labelled, posts, table
from moodlake.plans.registry import query
from moodlake.plans.scoring_queries import _POSTS_SCORED, _result
from moodlake.session import scratch_dir
from moodlake.sources.csv_files import read_csv
from moodlake.sources.store import read_enriched, write_enriched
from moodlake.streaming import ingest
from moodlake.streaming.enrich import run

_LACKING_SQL = "CAST(id AS BIGINT) % 3 = 0"


def _mixed_files(spark, sf_dir):
    """Raw posts in CSV files, a third of which have no time column."""
    folder = scratch_dir(spark, "csv")
    rows = _raw(spark, sf_dir)
    lacking = F.col("id").cast("long") % 3 == 0
    _write_csv(rows.filter(lacking).drop("timestamp"), f"{folder}/lacking", "UTF-8")
    _write_csv(rows.filter(~lacking), f"{folder}/whole", "UTF-8")
    return [f"{folder}/lacking", f"{folder}/whole"]


_OUTCOME_SQL = f"""CASE WHEN {_LACKING_SQL} THEN 'missing_column' WHEN {_STRIPPED} = '' THEN 'empty_text' ELSE 'accepted' END"""


@query(
    "csv_rejects",
    f"WITH {POSTS_SQL}, o AS (SELECT id, {_OUTCOME_SQL} AS reject_reason FROM posts) SELECT * FROM o WHERE reject_reason <> 'accepted'",
)
def _(spark, sf_dir):
    """A required column that a file's header lacks rejects the rows of that file."""
    _valid, rejects = validate(read_csv(spark, _mixed_files(spark, sf_dir)))
    return rejects.select("id", "reject_reason")


_COUNTS_SQL = f"WITH {POSTS_SQL} SELECT {_OUTCOME_SQL} AS outcome, count(*) AS n FROM posts GROUP BY 1"


@query("csv_outcomes", _COUNTS_SQL)
def _(spark, sf_dir):
    return reject_counts(tag_rejects(read_csv(spark, _mixed_files(spark, sf_dir))))


def _followed(spark, sf_dir):
    """The folder of a stream that took in raw posts from several files."""
    folder = scratch_dir(spark, "ingest")
    rows = _raw(spark, sf_dir)
    third = F.pmod(F.xxhash64("id"), F.lit(3))
    for k in range(3):
        _write_csv(rows.filter(third == k).coalesce(1), f"{folder}/raw/{k}", "UTF-8")
    run(ingest.follow(spark, f"{folder}/raw/*", f"{folder}/out", f"{folder}/checkpoint", trigger=None, max_files=1))
    return f"{folder}/out"


@query(
    "stream_ingest_counts",
    f"""WITH {POSTS_SQL} SELECT count(*) AS "read", count(*) FILTER ({_STRIPPED} <> '') AS accepted,
      count(*) FILTER ({_STRIPPED} = '') AS rejected FROM posts""",
)
def _(spark, sf_dir):
    """Counts observed while each micro-batch was stored, summed over the batches."""
    return ingest.progress(spark, _followed(spark, sf_dir)).agg(
        *[F.sum(c).alias(c) for c in ("read", "accepted", "rejected")]
    )


@query("stream_ingest_rejects", f"WITH {POSTS_SQL} SELECT id, 'empty_text' AS reject_reason FROM posts WHERE {_STRIPPED} = ''")
def _(spark, sf_dir):
    return spark.read.schema("id string, reject_reason string").json(f"{_followed(spark, sf_dir)}/rejects/*")


# An answer per event: every eleventh is no JSON, every seventh has no label, every fifth a quoted score.
@query(
    "score_json_answers",
    """SELECT event_id,
      CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN 'Neutral' ELSE 'Positive' END AS label,
      CASE WHEN event_id % 11 = 0 OR event_id % 5 = 0 THEN NULL ELSE round((event_id % 8) / 8.0::DOUBLE, 4) END AS score,
      CASE WHEN event_id % 11 <> 0 AND event_id % 3 = 0 THEN 'api_unavailable' END AS error FROM events""",
)
def _(spark, sf_dir):
    event = F.col("event_id")
    label = F.when(event % 7 == 0, "null").otherwise('"Positive"')
    number = F.format_string("%.3f", (event % 8) / F.lit(8.0))
    value = F.when(event % 5 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    error = F.when(event % 3 == 0, '"api_unavailable"').otherwise("null")
    text = F.concat(F.lit('{"label":'), label, F.lit(',"score":'), value, F.lit(',"error":'), error, F.lit("}"))
    answers = table(spark, sf_dir, "events").select("event_id", F.when(event % 11 == 0, "oops").otherwise(text).alias("answer"))
    parsed = answers.select("event_id", parse_score("answer").alias("s"))
    return parsed.select(
        "event_id", default_label("s.label").alias("label"), F.round(F.col("s.score").cast("double"), 4).alias("score"), "s.error",
    )


@query(
    "unlabelled_in_store",
    f"""WITH {LABELLED_SQL} SELECT id, CASE WHEN CAST(id AS BIGINT) % 4 < 2 THEN 'Neutral' ELSE sentiment_label END AS sentiment_label
      FROM labelled""",
)
def _(spark, sf_dir):
    """Posts whose label is missing or empty are stored under the default label."""
    kind = F.col("id").cast("long") % 4
    label = F.when(kind == 0, F.lit(None)).when(kind == 1, "").otherwise(F.col("sentiment_label"))
    path = scratch_dir(spark, "store")
    write_enriched(stored_shape(labelled(spark, sf_dir).withColumn("sentiment_label", label)), path)
    return read_enriched(spark, path).select("id", "sentiment_label")


@query("score_retried", _POSTS_SCORED)
def _(spark, sf_dir):
    """A service that refuses every call at first: retries give each post the answer it would have had."""

    def flaky():
        answer, refused = keyword_scorer(), set()

        def call(texts):
            if (key := tuple(texts)) not in refused:
                refused.add(key)
                raise RateLimited(0)
            return answer(texts)

        return call

    patient = RetryPolicy(sleep=lambda seconds: None)
    return _result(score(clean_posts(posts(spark, sf_dir)), flaky, retry=patient, tasks=3), "id")


# Labels by phrase, so that a fitted classifier has one right answer for every text.
_TAUGHT = ("Positive", "Negative", "Neutral", "Negative", "Neutral", "Neutral", "Positive", "Negative")
_TAUGHT_SQL = "CASE CAST(id AS BIGINT) % 8 " + " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(_TAUGHT)) + " END"
_SMALL = classifier.ClassifierParams(features=2048, max_iter=40)


def _taught(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, _TAUGHT)), (F.col("id").cast("long") % 8 + 1).cast("int"))
    rows = stored_labelled(spark, sf_dir).select("id", "cleaned_text", label.alias("sentiment_label"))
    return rows.withColumn("filled", F.trim("cleaned_text") != "")


@query(
    "train_save_load_score",
    f"""WITH {LABELLED_SQL} SELECT id, CASE WHEN trim(cleaned_text) = '' THEN 'Neutral' ELSE {_TAUGHT_SQL} END AS sentiment_label,
      trim(cleaned_text) <> '' AS sure, CASE WHEN trim(cleaned_text) = '' THEN 'empty_text' END AS inference_error FROM labelled""",
)
def _(spark, sf_dir):
    """Fit, save, load, and score all posts with the loaded model in the remote one's place."""
    rows = _taught(spark, sf_dir)
    folder = scratch_dir(spark, "model")
    model, _seconds = classifier.fit_classifier(hash_split(rows.filter("filled"))[0], _SMALL)
    classifier.save(model, f"{folder}/pipeline", f"{folder}/regression")
    scored = classifier.score_with_model(classifier.load(f"{folder}/pipeline"), rows.select("id", "cleaned_text"))
    return scored.select("id", "sentiment_label", (F.col("confidence_score") > 0.5).alias("sure"), "inference_error")


@query(
    "train_report",
    f"""WITH {LABELLED_SQL}, t AS (SELECT id, {_TAUGHT_SQL} AS class FROM labelled WHERE trim(cleaned_text) <> ''
      AND ('0x' || substr(md5(id), 1, 8))::BIGINT % 100 >= 80)
    SELECT class, count(*) AS support, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1 FROM t GROUP BY 1""",
)
def _(spark, sf_dir):
    """The report on held-out posts; those with a label the model never saw are left out."""
    train, test = hash_split(_taught(spark, sf_dir).filter("filled"))
    model, _seconds = classifier.fit_classifier(train, _SMALL)
    strange = test.limit(3).withColumn("sentiment_label", F.lit("Puzzled"))
    known = classifier.known_labels_only(test.unionByName(strange), model)
    report = evaluation.class_report(classifier.predict(model, known), "sentiment_label", "predicted_label")
    return report.select("class", "support", "precision", "recall", "f1")
