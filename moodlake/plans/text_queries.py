"""Cleaning, keywords, tokens and terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake.functions.text import clean_text, keyword_sentiment, tokens
from moodlake.operators.search import text_search
from moodlake.operators.terms import term_stats
from moodlake.plans.posts_view import (
    LABELLED_SQL, POSTS_SQL, clean_sql, keyword_sql, labelled, posts, table,
)
from moodlake.plans.registry import query


@query("clean_text", f"WITH {POSTS_SQL} SELECT id, {clean_sql('tweet_text')} AS cleaned_text FROM posts")
def _(spark, sf_dir):
    return posts(spark, sf_dir).select("id", clean_text("tweet_text").alias("cleaned_text"))


@query(
    "clean_keep_hashtags",
    f"WITH {POSTS_SQL} SELECT id, {clean_sql('tweet_text', hashtags=False)} AS cleaned_text FROM posts",
)
def _(spark, sf_dir):
    cleaned = clean_text("tweet_text", drop_hashtags=False)
    return posts(spark, sf_dir).select("id", cleaned.alias("cleaned_text"))


@query("clean_trimmed", f"WITH {POSTS_SQL} SELECT id, trim({clean_sql('tweet_text')}) AS cleaned_text FROM posts")
def _(spark, sf_dir):
    return posts(spark, sf_dir).select("id", clean_text("tweet_text", trim=True).alias("cleaned_text"))


@query("clean_documents", f"SELECT doc_id, {clean_sql('text')} AS cleaned_text FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("cleaned_text"))


@query("clean_conversations", f"SELECT conv_id, turn, {clean_sql('text')} AS cleaned_text FROM conversations")
def _(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", clean_text("text").alias("cleaned_text"))


@query("clean_pages", f"SELECT page_id, {clean_sql('html')} AS cleaned_text FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", clean_text("html").alias("cleaned_text"))


@query(
    "keyword_sentiment",
    f"WITH {POSTS_SQL} SELECT id, {keyword_sql('tweet_text', 'id')} AS sentiment_label FROM posts",
)
def _(spark, sf_dir):
    return posts(spark, sf_dir).select("id", keyword_sentiment("tweet_text", "id").alias("sentiment_label"))


@query(
    "keyword_sentiment_documents",
    f"SELECT doc_id, {keyword_sql('text', 'CAST(doc_id AS VARCHAR)')} AS sentiment_label FROM documents",
)
def _(spark, sf_dir):
    label = keyword_sentiment("text", "doc_id").alias("sentiment_label")
    return table(spark, sf_dir, "documents").select("doc_id", label)


@query(
    "keyword_sentiment_pages",
    f"SELECT page_id, {keyword_sql('html', 'url')} AS sentiment_label FROM pages",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", keyword_sentiment("html", "url").alias("sentiment_label"))


# Trailing whitespace goes before the split, as trailing empty tokens do in Spark ML.
_WORDS = r"""CASE WHEN rtrim({0}) = '' AND {0} <> '' THEN [] ELSE string_split(rtrim({0}), ' ') END"""


@query(
    "tokens",
    f"""WITH {LABELLED_SQL}, t AS (SELECT id, {_WORDS.format('cleaned_text')} AS words FROM labelled)
    SELECT id, CAST(len(words) AS INTEGER) AS n_tokens,
      coalesce(array_to_string(words, '|'), '') AS joined FROM t""",
)
def _(spark, sf_dir):
    words = tokens("cleaned_text")
    return labelled(spark, sf_dir).select(
        "id", F.size(words).alias("n_tokens"), F.concat_ws("|", words).alias("joined")
    )


IDF_SQL = "ln(((SELECT count(*) FROM texts) + 1) / (count(DISTINCT row) + 1))"


def words_sql(texts: str, columns: str) -> str:
    """Columns over all words of ``texts`` (row, cleaned_text), by term."""
    return f"""WITH {texts}, words AS (SELECT row, unnest({_WORDS.format('cleaned_text')}) AS term FROM texts)
    SELECT {columns}, CAST(count(*) AS BIGINT) AS tf, CAST(count(DISTINCT row) AS BIGINT) AS df FROM words GROUP BY term"""


def _term_sql(texts: str) -> str:
    return words_sql(texts, f"term, round({IDF_SQL}, 6) AS idf")


@query("term_stats", _term_sql(f"{LABELLED_SQL}, texts AS (SELECT id AS row, cleaned_text FROM labelled)"))
def _(spark, sf_dir):
    return term_stats(labelled(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


@query(
    "term_stats_documents",
    _term_sql(f"texts AS (SELECT doc_id AS row, {clean_sql('text')} AS cleaned_text FROM documents)"),
)
def _(spark, sf_dir):
    cleaned = table(spark, sf_dir, "documents").select(clean_text("text").alias("cleaned_text"))
    return term_stats(cleaned).withColumn("idf", F.round("idf", 6))


@query(
    "text_search",
    f"""WITH {LABELLED_SQL} SELECT id, original_text FROM labelled
    WHERE contains(original_text, 'café') OR contains(cleaned_text, 'café')""",
)
def _(spark, sf_dir):
    return text_search(labelled(spark, sf_dir), "café").select("id", "original_text")


@query(
    "text_search_pattern",
    rf"""WITH {LABELLED_SQL} SELECT id, original_text FROM labelled
    WHERE regexp_matches(original_text, '\bwork|day\b') OR regexp_matches(cleaned_text, '\bwork|day\b')""",
)
def _(spark, sf_dir):
    return text_search(labelled(spark, sf_dir), r"\bwork|day\b", regex=True).select("id", "original_text")


@query("text_search_documents", "SELECT doc_id, lang FROM documents WHERE contains(text, 'the and')")
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return text_search(documents, "the and", columns=("text",)).select("doc_id", "lang")
