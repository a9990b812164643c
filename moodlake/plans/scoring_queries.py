"""Model answers, guards and the pluggable scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake.functions.text import clean_text
from moodlake.operators.posts import clean_posts
from moodlake.operators.scoring import (
    keyword_scorer, score, score_columns, score_distinct, score_responses,
)
from moodlake.plans.posts_view import LABELLED_SQL, POSTS_SQL, clean_sql, keyword_sql, labelled, polarity_sql, posts, table
from moodlake.plans.registry import query


def _result(df, *keys):
    return df.select(
        *keys, "sentiment_label", F.round(F.col("confidence_score").cast("double"), 4).alias("confidence"),
        "inference_error",
    )


# Three candidates per event with scores in tenths, so that ties occur; every
# eleventh answer is broken.
@query(
    "top_prediction",
    """WITH c AS (SELECT event_id, event_id % 7 AS s0, event_id % 5 AS s2, event_id % 3 AS s1 FROM events),
    best AS (SELECT event_id, unnest([s0, s2, s1]) AS s, unnest(['Negative', 'Positive', 'Neutral']) AS label,
      unnest([1, 2, 3]) AS place FROM c),
    top AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY s DESC, place) AS rn FROM best)
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'Neutral' ELSE label END AS sentiment_label,
      CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE round(s / 10.0, 4) END::DOUBLE AS confidence,
      CASE WHEN event_id % 11 = 0 THEN 'api_unavailable' END AS inference_error
    FROM top WHERE rn = 1""",
)
def _(spark, sf_dir):
    event = F.col("event_id")

    def candidate(label, n):
        return F.format_string('{"label":"%s","score":0.%d}', F.lit(label), event % n)

    answer = F.concat(
        F.lit("[["), F.concat_ws(",", candidate("LABEL_0", 7), candidate("LABEL_2", 5), candidate("LABEL_1", 3)),
        F.when(event % 11 == 0, "").otherwise("]]"),
    )
    rows = table(spark, sf_dir, "events").select("event_id", answer.alias("response"), F.lit("some text").alias("text"))
    return _result(score_responses(rows, "response", text="text"), "event_id")


@query(
    "score_with_fallback",
    f"""WITH {LABELLED_SQL} SELECT id,
      CASE WHEN trim(cleaned_text) = '' OR inference_error IS NOT NULL THEN 'Neutral' ELSE model_label END AS sentiment_label,
      CASE WHEN trim(cleaned_text) = '' OR inference_error IS NOT NULL THEN 0.0 ELSE round(confidence_score, 4) END::DOUBLE AS confidence,
      CASE WHEN trim(cleaned_text) = '' THEN 'empty_text' ELSE inference_error END AS inference_error FROM labelled""",
)
def _(spark, sf_dir):
    raw = F.concat(F.lit("LABEL_"), F.array_position(
        F.array(F.lit("Negative"), F.lit("Neutral"), F.lit("Positive")), F.col("model_label")) - 1)
    rows = labelled(spark, sf_dir).select(
        "id", "cleaned_text", raw.alias("raw_label"), F.col("confidence_score").alias("raw_score"),
        F.col("inference_error").alias("raw_error"),
    )
    return _result(score_columns(rows, "raw_label", "raw_score", "raw_error"), "id")


def _keyword_scorer_sql(source: str, key: str) -> str:
    label = keyword_sql("cleaned_text", "cleaned_text")
    both = " AND ".join(polarity_sql("cleaned_text"))
    return f"""{source} SELECT {key},
      CASE WHEN trim(cleaned_text) = '' THEN 'Neutral' ELSE {label} END AS sentiment_label,
      CASE WHEN trim(cleaned_text) = '' THEN 0.0 WHEN {both} THEN 0.5 ELSE 1.0 END::DOUBLE AS confidence,
      CASE WHEN trim(cleaned_text) = '' THEN 'empty_text' END AS inference_error FROM c"""


_POSTS_SCORED = _keyword_scorer_sql(
    f"WITH {POSTS_SQL}, c AS (SELECT id, {clean_sql('tweet_text')} AS cleaned_text FROM posts)", "id"
)


@query("score_posts", _POSTS_SCORED)
def _(spark, sf_dir):
    return _result(score(clean_posts(posts(spark, sf_dir)), keyword_scorer), "id")


@query("score_distinct_posts", _POSTS_SCORED)
def _(spark, sf_dir):
    return _result(score_distinct(clean_posts(posts(spark, sf_dir)), keyword_scorer), "id")


@query("score_distinct_cold_posts", _POSTS_SCORED)
def _(spark, sf_dir):
    """Only texts with more than a hundredth of the rows come by broadcast: most take the shuffled join."""
    return _result(score_distinct(clean_posts(posts(spark, sf_dir)), keyword_scorer, hot_share=0.01), "id")


@query(
    "score_documents",
    _keyword_scorer_sql(f"WITH c AS (SELECT doc_id, {clean_sql('text')} AS cleaned_text FROM documents)", "doc_id"),
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("cleaned_text"))
    return _result(score(rows, keyword_scorer), "doc_id")


@query(
    "score_distinct_documents",
    _keyword_scorer_sql(f"WITH c AS (SELECT doc_id, {clean_sql('text')} AS cleaned_text FROM documents)", "doc_id"),
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("cleaned_text"))
    return _result(score_distinct(rows, keyword_scorer), "doc_id")
