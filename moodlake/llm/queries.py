"""Registered queries of this subpackage: one thin query per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.llm import alignment, ann, bpe, mixing, quality, rollup, secrets, sharding, simhash, substring, turns, urls, warc
from moodlake.llm.common import scratch_dir, table
from moodlake.llm.registry import ORACLES, QUERIES, query  # noqa: F401

VOCABULARY, MULTILINGUAL = "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"
LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"

OP7_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM t WHERE len(w) >= 20),
g AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM p),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r WHERE n > 1),
a AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM t),
k AS (
  SELECT a.doc_id, count(c.i) AS gone, string_agg(a.x, ' ' ORDER BY a.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.i GROUP BY a.doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(k.gone, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM t LEFT JOIN k ON t.doc_id = k.doc_id
"""


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = quality.text_measures(docs)
    judged = quality.judge_measured(measured.drop("text"))
    fields = [F.col(f"_quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select(
        "doc_id", *fields, "base_failed", "kept", F.array_join("host_failed_rules", ",").alias("host_failed_rules")
    )


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


@query("op6_source_mixing")
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sized(mixing.sized(docs, keep_text=False))
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@query("op7_substring_dedup", OP7_SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.written(secrets.strong_only()), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents under one vocabulary, move those not in English to another, repeat both batches."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    root = scratch_dir(spark, "token_counts")
    load = rollup.counted(docs, "byte_bpe_50k", public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    other = docs.filter("lang IS NULL OR lang <> 'en'")
    moved = rollup.counted(other, "byte_bpe_multi_50k", public_tokenizers.path(MULTILINGUAL), public_tokenizers.PATTERN)
    left = moved.withColumn("op", F.lit("delete")).withColumn("version", F.lit("byte_bpe_50k"))
    for _ in range(2):
        rollup.commit(spark, root, "load", load)
        rollup.commit(spark, root, "move", moved.unionByName(left))
    return rollup.totals(spark, root)


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels teach by equal number: the label of document n is taken for that of page n."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", bad.alias("bad"))
    return urls.judge(pages, labelled).select("row.page_id", "host", "path", "rule", "verdict", "mined_rule")


@query("op10_warc_bundles")
def op10_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_sharding")
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(sharding.packed(docs, keep_text=False)).select(
        "row.doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.report_all(turns.damage(rows), rows)


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.link_counts(docs, public_tokenizers.path(LEFT), public_tokenizers.path(RIGHT), public_tokenizers.PATTERN)
