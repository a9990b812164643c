"""Counts, shares, trends and questions to the store."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake.functions.display import clock, percent, thousands
from moodlake.functions.text import keyword_sentiment
from moodlake.operators import metrics, search, trend
from moodlake.operators.metrics import SOURCES
from moodlake.operators.split import hash_split, split_bucket
from moodlake.plans.posts_view import LABELLED_SQL, POSTS_SQL, keyword_sql, labelled, labelled_from, posts, table
from moodlake.plans.registry import query
from moodlake.session import scratch_dir
from moodlake.sources.store import read_enriched, write_enriched



def start_text():
    return F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")



@query(
    "class_distribution",
    f"WITH {LABELLED_SQL} SELECT sentiment_label, count(*) AS n FROM labelled GROUP BY 1 ORDER BY n DESC, 1",
)
def _(spark, sf_dir):
    return metrics.class_distribution(labelled(spark, sf_dir))


def _mix_sql(by: str) -> str:
    return f"""WITH {LABELLED_SQL} SELECT {by}, count(*) AS n,
      round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM labelled GROUP BY {by}"""


@query("sentiment_mix", _mix_sql("sentiment_label"))
def sentiment_mix(spark, sf_dir):
    return metrics.mix(labelled(spark, sf_dir), "sentiment_label")


@query("source_mix", _mix_sql("source"))
def _(spark, sf_dir):
    return metrics.mix(labelled(spark, sf_dir), "source")


@query(
    "document_source_mix",
    """SELECT source, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct
    FROM documents GROUP BY source""",
)
def _(spark, sf_dir):
    return metrics.mix(table(spark, sf_dir, "documents"), "source")


@query(
    "conversation_sentiment_mix",
    f"""SELECT {keyword_sql('text', 'CAST(conv_id AS VARCHAR)')} AS sentiment_label, count(*) AS n,
      round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM conversations GROUP BY 1""",
)
def _(spark, sf_dir):
    label = keyword_sentiment("text", "conv_id").alias("sentiment_label")
    return metrics.mix(table(spark, sf_dir, "conversations").select(label))


def _mix_row_sql(by: str, values: tuple[str, ...]) -> str:
    counts = ", ".join(f"count(*) FILTER ({by} = '{v}') AS {v.lower()}_n" for v in values)
    total = " + ".join(f"{v.lower()}_n" for v in values)
    shares = ", ".join(
        f"round(100.0::DOUBLE * {v.lower()}_n / greatest({total}, 1), 6) AS {v.lower()}_pct" for v in values
    )
    return f"WITH {LABELLED_SQL}, k AS (SELECT {counts} FROM labelled) SELECT *, {shares} FROM k"


SENTIMENT_ROW_SQL = _mix_row_sql("sentiment_label", ("Negative", "Neutral", "Positive"))


@query("sentiment_mix_row", SENTIMENT_ROW_SQL)
def _(spark, sf_dir):
    return metrics.mix_row(labelled(spark, sf_dir))


SOURCE_ROW_SQL = _mix_row_sql("source", SOURCES)


@query("source_mix_row", SOURCE_ROW_SQL)
def _(spark, sf_dir):
    return metrics.mix_row(labelled(spark, sf_dir), "source", SOURCES)


KPI_SQL = f"""WITH {LABELLED_SQL} SELECT count(*) AS total, round(100 * avg(confidence_score), 1) AS mean_confidence_pct,
      round(count(*) * 1000000.0::DOUBLE / (epoch_us(max(ts)) - epoch_us(min(ts))), 6) AS posts_per_second,
      CAST(least(99, floor(count(*) / 800)) AS INTEGER) AS alerts,
      round(100.0::DOUBLE * count(*) FILTER (sentiment_label = 'Positive') / count(*), 6) AS positive_pct FROM labelled"""


@query("kpi_summary", KPI_SQL)
def _(spark, sf_dir):
    return metrics.kpi_summary(labelled(spark, sf_dir))


THROUGHPUT_SQL = f"""WITH {POSTS_SQL} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
      count(*) AS n, round(count(*) / 3600.0::DOUBLE, 6) AS posts_per_second FROM posts GROUP BY 1"""


@query("throughput", THROUGHPUT_SQL)
def _(spark, sf_dir):
    return metrics.throughput(posts(spark, sf_dir)).select(start_text(), "n", "posts_per_second")


@query(
    "failure_rate",
    f"""WITH {POSTS_SQL} SELECT coalesce(inference_error, 'none') AS inference_error, count(*) AS n,
      round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM posts GROUP BY 1""",
)
def _(spark, sf_dir):
    return metrics.failure_rate(posts(spark, sf_dir))


def _trend_sql(unit: str = "day", tail: str = "") -> str:
    shares = ", ".join(
        f"round(100.0::DOUBLE * count(*) FILTER (sentiment_label = '{v}') / count(*), 6) AS {v.lower()}_pct"
        for v in ("Negative", "Neutral", "Positive")
    )
    return f"""WITH {LABELLED_SQL}, t AS (SELECT date_trunc('{unit}', ts) AS w, count(*) AS n, {shares}
      FROM labelled GROUP BY 1)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n, negative_pct, neutral_pct, positive_pct FROM t {tail}"""


TREND_SQL = _trend_sql()


def _shown(points):
    return points.select(start_text(), "n", "negative_pct", "neutral_pct", "positive_pct")


@query("sentiment_trend", TREND_SQL)
def _(spark, sf_dir):
    return _shown(trend.sentiment_trend(labelled(spark, sf_dir)))


@query("sentiment_trend_hourly", _trend_sql("hour"))
def _(spark, sf_dir):
    return _shown(trend.sentiment_trend(labelled(spark, sf_dir), "1 hour"))


@query("trend_sampled", _trend_sql(tail="WHERE (epoch(w)::BIGINT // 86400) % 3 = 0"))
def _(spark, sf_dir):
    return _shown(trend.sampled_trend(trend.sentiment_trend(labelled(spark, sf_dir))))


def _register_view(view: str, n: int) -> None:
    @query(f"trend_last_{n}", _trend_sql(tail=f"ORDER BY w DESC LIMIT {n}"))
    def _(spark, sf_dir):
        return _shown(trend.last_points(trend.sentiment_trend(labelled(spark, sf_dir)), view))


for _view, _n in trend.VIEWS.items():
    _register_view(_view, _n)


FEED_SQL = f"""WITH {LABELLED_SQL} SELECT id, strftime(ts, '%H:%M:%S') AS at, upper(sentiment_label) AS sentiment,
      source, printf('%.1f%%', confidence_score * 100) AS confidence FROM labelled ORDER BY ts DESC, id DESC LIMIT 7"""


@query("recent_feed", FEED_SQL)
def _(spark, sf_dir):
    # Pick first, then label: only the seven rows shown are labelled.
    return shown_feed(labelled_from(trend.recent_feed(posts(spark, sf_dir))))


def shown_feed(feed):
    return feed.select(
        "id", clock("timestamp").alias("at"), F.upper("sentiment_label").alias("sentiment"), "source",
        percent(F.col("confidence_score").cast("double") * 100).alias("confidence"),
    )


@query(
    "display_formats",
    f"""WITH {LABELLED_SQL} SELECT source, format('{{:,}}', count(*)) AS posts,
      printf('%.1f%%', 100.0::DOUBLE * count(*) / (SELECT count(*) FROM labelled)) AS share,
      strftime(max(ts), '%H:%M:%S') AS latest FROM labelled GROUP BY source""",
)
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("ts"))
    total = per_source.agg(F.sum("n")).scalar()
    return per_source.select(
        "source", thousands("n").alias("posts"), percent(100.0 * F.col("n") / total).alias("share"),
        clock("ts").alias("latest"),
    )


@query(
    "hash_split_counts",
    f"""WITH {POSTS_SQL} SELECT CASE WHEN ('0x' || substr(md5(id), 1, 8))::BIGINT % 100 < 80 THEN 'train'
      ELSE 'test' END AS side, count(*) AS n FROM posts GROUP BY 1""",
)
def _(spark, sf_dir):
    side = F.when(split_bucket("id") < 80, "train").otherwise("test")
    return posts(spark, sf_dir).groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "hash_split_test_side",
    f"WITH {POSTS_SQL} SELECT id, tweet_text FROM posts WHERE ('0x' || substr(md5(id), 1, 8))::BIGINT % 100 >= 80",
)
def _(spark, sf_dir):
    _train, test = hash_split(posts(spark, sf_dir))
    return test.select("id", "tweet_text")


_STORES: dict[tuple[str, str], str] = {}


def _new_store(spark, sf_dir):
    path = scratch_dir(spark, "store")
    write_enriched(labelled(spark, sf_dir), path)
    return path


def _store(spark, sf_dir):
    """All labelled posts in an enriched store, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        _STORES[key] = _new_store(spark, sf_dir)
    return read_enriched(spark, _STORES[key])


@query(
    "backfill_store",
    f"""WITH {LABELLED_SQL} SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, original_text, cleaned_text,
      sentiment_label, round(confidence_score, 4) AS confidence FROM labelled""",
)
def _(spark, sf_dir):
    return read_enriched(spark, _new_store(spark, sf_dir)).select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "original_text", "cleaned_text",
        "sentiment_label", F.round(F.col("confidence_score").cast("double"), 4).alias("confidence"),
    )


@query("positive_count", f"WITH {LABELLED_SQL} SELECT count(*) AS n FROM labelled WHERE sentiment_label = 'Positive'")
def _(spark, sf_dir):
    return search.label_count(_store(spark, sf_dir))


@query(
    "term_mix_last_hour",
    f"""WITH {LABELLED_SQL}, recent AS (SELECT * FROM labelled WHERE contains(original_text, 'it')
      OR contains(cleaned_text, 'it')), top AS (SELECT max(ts) AS t FROM labelled)
    SELECT sentiment_label, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share_pct
    FROM recent, top WHERE ts > t - INTERVAL 1 HOUR AND ts <= t GROUP BY 1""",
)
def _(spark, sf_dir):
    rows = _store(spark, sf_dir)
    newest = rows.agg(F.max("timestamp")).scalar()
    return search.term_mix(rows, "it", newest)
