"""Posts derived from the ``events`` table, one per event, and their SQL twin.

The given texts hold hardly any URLs, tags or sentiment words, so each event
gets a phrase and decorations chosen by its id. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moodlake.functions.text import NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS, clean_text, keyword_sentiment
from moodlake.operators.ingest import messages
from moodlake.session import spread

PHRASES = (
    "I love this, truly amazing!",
    "Terrible. It crashes daily...",
    "It arrived on Tuesday",
    "Best price, yet broken on day one",
    "Naïve café review — fine",
    "The prefix  was   odd",
    "OUTSTANDING work (really)",
    "Poor value & a waste",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Timestamps without zone are UTC throughout.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's files as a stream; the glob fits a file and a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _every(n: int, text: Column) -> Column:
    return F.when(F.col("event_id") % n == 0, text).otherwise("")


def posts_from_events(events: DataFrame) -> DataFrame:
    """id, timestamp, tweet_text, source, model_label, model_score, inference_error."""
    event = F.col("event_id")
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (event % 8 + 1).cast("int"))
    text = F.concat(
        _every(5, F.concat(F.lit("@user"), F.col("user_id").cast("string"), F.lit(" "))),
        phrase,
        _every(4, F.concat(F.lit(" http://t.co/"), event.cast("string"))),
        _every(7, F.concat(F.lit(" #"), F.col("event_type"))),
    )
    failed = event % 53 == 0
    return events.select(
        event.cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(event % 97 == 0, "   ").otherwise(text).alias("tweet_text"),
        F.when(event % 100 < 40, "twitter").when(event % 100 < 68, "reddit")
        .when(event % 100 < 86, "news").otherwise("other").alias("source"),
        F.when(failed, "Neutral").when(event % 10 < 3, "Negative")
        .when(event % 10 < 6, "Neutral").otherwise("Positive").alias("model_label"),
        F.when(failed, 0.0).otherwise(0.5 + (event % 50) / 100.0).alias("model_score"),
        F.when(failed, "api_unavailable").alias("inference_error"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_events(table(spark, sf_dir, "events"))


def spread_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same posts, made in many tasks: events are few bytes, and a text and what becomes of it many."""
    return posts_from_events(spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")))


def labelled_from(rows: DataFrame) -> DataFrame:
    """Posts cleaned and labelled by keyword, next to the model's columns."""
    return rows.select(
        "id", "timestamp", F.col("tweet_text").alias("original_text"),
        clean_text("tweet_text").alias("cleaned_text"),
        keyword_sentiment("tweet_text", "id").alias("sentiment_label"),
        F.col("model_score").cast("float").alias("confidence_score"),
        "model_label", "inference_error", "source",
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_from(posts(spark, sf_dir))


def broker_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as broker messages, streamed."""
    return messages(posts_from_events(stream_table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- SQL twin

_VALUES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(PHRASES))

POSTS_SQL = f"""posts AS (
SELECT CAST(e.event_id AS VARCHAR) AS id, e.ts AS ts,
  CASE WHEN e.event_id % 97 = 0 THEN '   '
       ELSE concat(
         CASE WHEN e.event_id % 5 = 0 THEN concat('@user', CAST(e.user_id AS VARCHAR), ' ') ELSE '' END,
         p.phrase,
         CASE WHEN e.event_id % 4 = 0 THEN concat(' http://t.co/', CAST(e.event_id AS VARCHAR)) ELSE '' END,
         CASE WHEN e.event_id % 7 = 0 THEN concat(' #', e.event_type) ELSE '' END) END AS tweet_text,
  CASE WHEN e.event_id % 100 < 40 THEN 'twitter' WHEN e.event_id % 100 < 68 THEN 'reddit'
       WHEN e.event_id % 100 < 86 THEN 'news' ELSE 'other' END AS source,
  CASE WHEN e.event_id % 53 = 0 THEN 'Neutral' WHEN e.event_id % 10 < 3 THEN 'Negative'
       WHEN e.event_id % 10 < 6 THEN 'Neutral' ELSE 'Positive' END AS model_label,
  CASE WHEN e.event_id % 53 = 0 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE + (e.event_id % 50) / 100.0::DOUBLE END AS model_score,
  CASE WHEN e.event_id % 53 = 0 THEN 'api_unavailable' END AS inference_error
FROM events e JOIN (VALUES {_VALUES}) AS p(k, phrase) ON e.event_id % 8 = p.k)"""

_SPACE = r" \t\n\x0B\f\r"


def clean_sql(text: str, hashtags: bool = True) -> str:
    """The cleaning as five plain steps."""
    out = rf"regexp_replace({text}, 'http[^{_SPACE}]+', '', 'g')"
    out = rf"regexp_replace({out}, '@\w+', '', 'g')"
    if hashtags:
        out = rf"regexp_replace({out}, '#\w+', '', 'g')"
    out = rf"regexp_replace({out}, '[^a-zA-Z0-9{_SPACE}]', ' ', 'g')"
    return rf"lower(regexp_replace({out}, '[{_SPACE}]+', ' ', 'g'))"


# Characters around text that count as whitespace: see functions.text.WHITESPACE.
WHITESPACE_SQL = "(" + " || ".join(
    f"chr({n})" for n in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                          0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
) + ")"


def polarity_sql(text: str) -> tuple[str, str]:
    """Whether a text holds a good word, and whether a bad one."""
    def any_of(words: tuple[str, ...]) -> str:
        return "(" + " OR ".join(f"lower({text}) LIKE '%{w}%'" for w in words) + ")"

    return any_of(POSITIVE_KEYWORDS), any_of(NEGATIVE_KEYWORDS)


def keyword_sql(text: str, tie_key: str) -> str:
    good, bad = polarity_sql(text)
    even = f"substr(md5({tie_key}), 32, 1) IN ('0','2','4','6','8','a','c','e')"
    return f"""CASE WHEN {good} AND {bad} THEN CASE WHEN {even} THEN 'Positive' ELSE 'Negative' END
  WHEN {good} THEN 'Positive' WHEN {bad} THEN 'Negative' ELSE 'Neutral' END"""


LABELLED_SQL = f"""{POSTS_SQL}, labelled AS (
SELECT id, ts, tweet_text AS original_text, {clean_sql('tweet_text')} AS cleaned_text,
  {keyword_sql('tweet_text', 'id')} AS sentiment_label,
  CAST(CAST(model_score AS FLOAT) AS DOUBLE) AS confidence_score, model_label, inference_error, source FROM posts)"""
