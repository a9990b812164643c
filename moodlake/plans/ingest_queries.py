"""Validation, timestamps, JSON, CSV."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlake.functions.payload import post_json
from moodlake.functions.timestamps import normalise_timestamp
from moodlake.operators.ingest import messages, normalise, reject_counts, tag_rejects, validate
from moodlake.operators.posts import clean_posts, decode_posts
from moodlake.plans.posts_view import POSTS_SQL, WHITESPACE_SQL, clean_sql, posts, table
from moodlake.plans.registry import query
from moodlake.session import scratch_dir
from moodlake.sources.csv_files import CSV_OPTIONS, read_csv

_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_TIME_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_STRIPPED = f"trim(tweet_text, {WHITESPACE_SQL})"


def _raw(spark, sf_dir):
    """Posts as rows of a raw file: text columns only."""
    return posts(spark, sf_dir).select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "tweet_text"
    )


@query(
    "ingest_validate",
    f"""WITH {POSTS_SQL} SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {_STRIPPED} AS tweet_text,
      FALSE AS ts_defaulted FROM posts WHERE {_STRIPPED} <> ''""",
)
def _(spark, sf_dir):
    valid, _rejects = validate(_raw(spark, sf_dir))
    return normalise(valid).select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"), "tweet_text", "ts_defaulted"
    )


@query(
    "ingest_rejects",
    f"WITH {POSTS_SQL} SELECT id, 'empty_text' AS reject_reason FROM posts WHERE {_STRIPPED} = ''",
)
def _(spark, sf_dir):
    _valid, rejects = validate(_raw(spark, sf_dir))
    return rejects.select("id", "reject_reason")


@query(
    "ingest_counts",
    f"""WITH {POSTS_SQL} SELECT CASE WHEN {_STRIPPED} = '' THEN 'empty_text' ELSE 'accepted' END AS outcome,
      count(*) AS n FROM posts GROUP BY 1""",
)
def _(spark, sf_dir):
    return reject_counts(tag_rejects(_raw(spark, sf_dir)))


# One text format per event, by id: the six accepted ones, an impossible day and junk.
_FORMATS = (
    ("EEE MMM dd HH:mm:ss 'PDT' yyyy", "%a %b %d %H:%M:%S PDT %Y"),
    ("EEE MMM dd HH:mm:ss '-0700' yyyy", "%a %b %d %H:%M:%S -0700 %Y"),
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
    ("yyyy-MM-dd'T'HH:mm:ss'+0500'", "%Y-%m-%dT%H:%M:%S+0500"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:00'", "%Y-%m-%dT%H:%M:%S.%f+05:00"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("dd/MM/yyyy HH:mm:ss", "%d/%m/%Y %H:%M:%S"),
    ("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S"),
    ("'2024-02-31 'HH:mm:ss", "2024-02-31 %H:%M:%S"),
    ("'junk 'HH:mm", "junk %H:%M"),
)
_RAW_SQL = "CASE event_id % 10 " + " ".join(
    f"WHEN {i} THEN strftime(ts, '{fmt}')" for i, (_, fmt) in enumerate(_FORMATS)
) + " END"


@query(
    "timestamp_normalise",
    f"""WITH raw AS (SELECT event_id, ts, date_trunc('second', ts) AS sec, {_RAW_SQL} AS raw FROM events),
    parsed AS (SELECT event_id, raw, CASE event_id % 10
      WHEN 0 THEN sec + INTERVAL 7 HOUR WHEN 1 THEN sec + INTERVAL 7 HOUR WHEN 2 THEN sec
      WHEN 3 THEN sec - INTERVAL 5 HOUR WHEN 4 THEN ts - INTERVAL 5 HOUR
      ELSE coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%d/%m/%Y %H:%M:%S'),
        try_strptime(raw, '%m/%d/%Y %H:%M:%S')) END AS ts FROM raw)
    SELECT event_id, raw, {_TIME_SQL} AS parsed, ts IS NULL AS ts_defaulted FROM parsed""",
)
def _(spark, sf_dir):
    event = F.col("event_id")
    raw = F.lit(None).cast("string")
    for i, (pattern, _sql) in enumerate(_FORMATS):
        raw = F.when(event % 10 == i, F.date_format("ts", pattern)).otherwise(raw)
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    parsed = rows.withColumn("ts", normalise_timestamp("raw"))
    return parsed.select(
        "event_id", "raw", F.date_format("ts", _TIME).alias("parsed"), F.col("ts").isNull().alias("ts_defaulted")
    )


@query(
    "json_roundtrip",
    f"""WITH {POSTS_SQL} SELECT id, {_TIME_SQL} AS ts, tweet_text AS original_text,
      {clean_sql('tweet_text')} AS cleaned_text FROM posts""",
)
def _(spark, sf_dir):
    decoded = clean_posts(decode_posts(messages(posts(spark, sf_dir))))
    ts = F.date_format(F.try_to_timestamp("timestamp"), _TIME)
    return decoded.select("id", ts.alias("ts"), "original_text", "cleaned_text")


@query("events_props_decode", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _(spark, sf_dir):
    props = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def _write_csv(rows, path, encoding):
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "mode"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(**options, encoding=encoding).csv(path)


_CSV_TEXT_SQL = r"""concat(replace(tweet_text, '—', '-'), chr(10), '"from", ', source)"""


@query(
    "csv_roundtrip",
    f"""WITH {POSTS_SQL} SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
      trim({_CSV_TEXT_SQL}, {WHITESPACE_SQL}) AS tweet_text FROM posts""",
)
def _(spark, sf_dir):
    """Posts written as CSV, one part of the files in Latin-1, and read back."""
    rows = posts(spark, sf_dir).select(
        "source", "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.replace("tweet_text", F.lit("—"), F.lit("-")), F.lit('\n"from", '), "source").alias("tweet_text"),
    )
    folder = scratch_dir(spark, "csv")
    is_latin = F.col("source") == "twitter"
    _write_csv(rows.filter(is_latin).drop("source"), f"{folder}/latin", "ISO-8859-1")
    _write_csv(rows.filter(~is_latin).drop("source"), f"{folder}/utf", "UTF-8")
    valid, _rejects = validate(read_csv(spark, [f"{folder}/latin", f"{folder}/utf"]))
    return normalise(valid).select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"), "tweet_text"
    )


_TURN_ID = "concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR))"


def _turns(spark, sf_dir):
    """Conversation turns as posts; they carry no time of their own."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.lit("2024-01-02T03:04:05+00:00").alias("timestamp"), F.col("text").alias("tweet_text"),
    )


@query(
    "ingest_conversations",
    f"""SELECT {_TURN_ID} AS id, '2024-01-02 03:04:05' AS ts, trim(text, {WHITESPACE_SQL}) AS tweet_text,
      FALSE AS ts_defaulted FROM conversations WHERE trim(text, {WHITESPACE_SQL}) <> ''""",
)
def _(spark, sf_dir):
    valid, _rejects = validate(_turns(spark, sf_dir))
    return normalise(valid).select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"), "tweet_text", "ts_defaulted"
    )


@query(
    "json_roundtrip_pages",
    f"""SELECT CAST(page_id AS VARCHAR) AS id, url AS "timestamp", html AS original_text,
      {clean_sql('html')} AS cleaned_text FROM pages""",
)
def _(spark, sf_dir):
    """Whole web pages through the broker's JSON and back."""
    pages = table(spark, sf_dir, "pages").select(
        post_json(F.col("page_id").cast("string"), "url", "html").alias("value")
    )
    return clean_posts(decode_posts(pages))


@query(
    "csv_roundtrip_conversations",
    f"SELECT {_TURN_ID} AS id, trim(text, {WHITESPACE_SQL}) AS tweet_text FROM conversations",
)
def _(spark, sf_dir):
    """Real text with newlines and quotes through CSV and back."""
    folder = scratch_dir(spark, "csv")
    _write_csv(_turns(spark, sf_dir), folder, "UTF-8")
    return normalise(read_csv(spark, folder)).select("id", "tweet_text")


_FIRST = 700


@query(
    "csv_first_rows",
    f"""WITH {POSTS_SQL} SELECT id, concat(tweet_text, chr(10), source) AS tweet_text FROM posts
      ORDER BY CAST(id AS BIGINT) LIMIT {_FIRST}""",
)
def _(spark, sf_dir):
    """The first input rows, blank ones included, of files whose fields hold newlines: a cap that ends inside a later file."""
    folder = scratch_dir(spark, "csv")
    rows = posts(spark, sf_dir).select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat("tweet_text", F.lit("\n"), "source").alias("tweet_text"), F.col("id").cast("long").alias("place"),
    )
    # The files' names are in the order of ids, a file per range of them; the first folder holds part of the wanted rows.
    for name, part in (("1", F.col("place") < _FIRST // 2), ("2", F.col("place") >= _FIRST // 2)):
        ranges = rows.filter(part).repartitionByRange("place").sortWithinPartitions("place")
        _write_csv(ranges.drop("place"), f"{folder}/{name}", "UTF-8")
    return read_csv(spark, [f"{folder}/1", f"{folder}/2"], max_records=_FIRST).select("id", "tweet_text")


@query("csv_documents", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, text FROM documents")
def _(spark, sf_dir):
    """Whole documents, newlines and all, in files of three column orders."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", "text")
    folder = scratch_dir(spark, "csv")
    orders = (("doc_id", "lang", "source", "text"), ("text", "doc_id", "source", "lang"), ("lang", "text", "source", "doc_id"))
    for k, order in enumerate(orders):
        part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == k)
        _write_csv(part.select(*order), f"{folder}/{k}", "UTF-8")
    return read_csv(spark, [f"{folder}/{k}" for k in range(3)]).select("doc_id", "lang", "source", "text")
