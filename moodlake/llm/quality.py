"""Quality rules judged with the help of the host: failures by host, shrunk by a beta prior, joined back.

A document that fails a base rule is rejected whatever its host. The milder
rules err on single documents, so a document that fails one of them is
rejected only where its host fails that rule in general: the host's failure
rate, drawn towards the rate of all hosts by an empirical beta prior, exceeds
a limit. A document that fails no rule is always kept.

Everything here is a DataFrame expression; texts are never shuffled by
``text_measures`` and only their measures by ``judge``.

Defined results: a NULL or empty text has no words and fails the base rules; a
NULL host is a host of its own; repeated rows count and are returned each;
an empty table gives an empty result; other columns pass through unchanged,
except that ``judge`` replaces a column that has the name of one of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import join_hot, scratch_table, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PCT = 30
# Milder rules: name -> condition on the measures under which a document fails.
HOST_RULES: dict[str, str] = {
    "symbols": "n_symbols > 0.1 * n_words",
    "duplicate_lines": "n_dup_lines > 0.3 * n_lines",
    "short_words": "word_chars < 3 * n_words",
}
HOST_LIMIT = 0.5
# Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RESERVED = "_quality"
VERDICTS = ("base_failed", "failed_rules", "host_failed_rules", "kept")


def _window_hash(tokens: Column, start: Column, *salt: Column) -> Column:
    return F.xxhash64(*salt, *[F.get(tokens, start + j) for j in range(WINDOW)])


def _covered(starts: Column) -> Column:
    """Words covered by windows at these sorted starts."""
    steps = F.sequence(F.lit(0), F.size(starts) - 2)
    gaps = F.aggregate(
        steps, F.lit(0), lambda acc, k: acc + F.least(F.lit(WINDOW), F.get(starts, k + 1) - F.get(starts, k))
    )
    return F.when(F.size(starts) < 2, F.lit(0)).otherwise(gaps + WINDOW)


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the struct column ``_quality`` with the measures of each whole text.

    The windows of a document are compared by hash inside its row. Only a
    document that has two equal hashes goes on to the sort that finds which
    words they cover.
    """
    keep = docs.columns
    q = RESERVED
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select("*", words(text).alias(f"{q}_words"), lines.alias(f"{q}_lines"))
    tokens = F.col(f"{q}_words")
    n = F.size(tokens)
    hashes = F.when(
        n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: _window_hash(tokens, i))
    ).otherwise(F.array().cast("array<bigint>"))
    step = step.select(
        *keep, f"{q}_words",
        n.cast("long").alias(f"{q}_n"),
        F.length(F.array_join(tokens, "")).cast("long").alias(f"{q}_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]", ""))).cast("long").alias(f"{q}_symbols"),
        F.size(f"{q}_lines").cast("long").alias(f"{q}_nl"),
        (F.size(f"{q}_lines") - F.size(F.array_distinct(f"{q}_lines"))).cast("long").alias(f"{q}_dup"),
        hashes.alias(f"{q}_hashes"),
    )
    hashed = F.col(f"{q}_hashes")
    numbers = [f"{q}_n", f"{q}_chars", f"{q}_symbols", f"{q}_nl", f"{q}_dup"]
    keyed = F.when(
        F.size(F.array_distinct(hashed)) < F.size(hashed),
        F.sort_array(F.transform(hashed, lambda h, i: F.struct(
            h.alias("h"), _window_hash(tokens, i, F.lit(1)).alias("g"), i.alias("i")
        ))),
    )
    step = step.select(*keep, *numbers, keyed.alias(f"{q}_keyed"))
    pairs = F.col(f"{q}_keyed")

    def same(x: Column, at: Column) -> Column:
        other = F.get(pairs, at)
        return x["h"].eqNullSafe(other["h"]) & x["g"].eqNullSafe(other["g"])

    starts = F.sort_array(F.transform(
        F.filter(pairs, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]
    ))
    step = step.select(*keep, *numbers, starts.alias(f"{q}_starts"))
    repeated = F.when(F.col(f"{q}_starts").isNull(), F.lit(0)).otherwise(_covered(F.col(f"{q}_starts")))
    values = [*numbers, repeated.cast("long")]
    return step.select(*keep, F.struct(*[
        (F.col(v) if isinstance(v, str) else v).alias(name) for name, v in zip(MEASURES, values)
    ]).alias(q))


def base_failed(measures: str = RESERVED) -> Column:
    """Too few words, or too large a share of them inside repeated windows."""
    m = F.col(measures)
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PCT * m["n_words"])


def _fails(rule: str) -> Column:
    condition = HOST_RULES[rule]
    for name in MEASURES:
        condition = condition.replace(name, f"{RESERVED}.{name}")
    return F.expr(condition)


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: its documents, and for each rule its failures and shrunk failure rate.

    The prior of a rule is the beta distribution with the mean of the hosts'
    rates, weighted by their documents, and with their variance less what
    binomial sampling adds to it (beta-binomial moments). Two standard errors of
    the hosts' correlation are taken off it, so hosts too small to show a
    difference between hosts give the widest weight. Where large hosts fail a
    rule nearly always or nearly never, the least weight holds and one failure
    still speaks against a host of one document. Failures are
    added up before the shuffle, so a host with a third of all rows is one row
    per task. One row with the sums of all hosts goes to the driver.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.coalesce(_fails(rule), F.lit(False)).cast("long")).alias(f"{rule}_failed") for rule in HOST_RULES],
    )
    hosts = scratch_table(hosts, "hosts")
    square = F.col("n_docs").cast("decimal(19,0)") * F.col("n_docs").cast("decimal(19,0)")
    sums = hosts.agg(F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("hosts"), F.sum(square).alias("squares"),
                     F.sum(1 - 1 / F.col("n_docs")).alias("free"), *[F.sum(f"{rule}_failed").alias(rule) for rule in HOST_RULES]).first()
    if not sums["n"]:
        return hosts.select("*", *[F.lit(0.0).alias(f"{rule}_rate") for rule in HOST_RULES])
    mean = {rule: sums[rule] / sums["n"] for rule in HOST_RULES}
    spread = hosts.agg(*[
        (F.sum(F.col("n_docs") * F.pow(F.col(f"{rule}_failed") / F.col("n_docs") - mean[rule], 2)) / sums["n"]).alias(rule)
        for rule in HOST_RULES
    ]).first()

    def shrunk(rule: str) -> Column:
        m, v = mean[rule], spread[rule]
        n, others = sums["n"], sums["hosts"] - 1
        # E[v] / (m (1 - m)) = others / n + correlation * known / n; known is 0 where every host has one document.
        known = (n * (n - others) - int(sums["squares"])) / n
        weight = MOST_WEIGHT
        if v > 0 and known > 0:
            correlation = min((v * n / (m * (1 - m)) - others) / known, 1.0) - 2 * math.sqrt(2 * sums["free"]) / known
            weight = 1 / correlation - 1 if correlation > 0 else MOST_WEIGHT
        weight = min(max(weight, LEAST_WEIGHT), MOST_WEIGHT)
        return (F.col(f"{rule}_failed") + m * weight) / (F.col("n_docs") + weight)

    return hosts.select("*", *[shrunk(rule).alias(f"{rule}_rate") for rule in HOST_RULES])


def judge(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Measure and judge: adds ``_quality``, ``base_failed``, ``failed_rules``, ``host_failed_rules`` and ``kept``."""
    judged = judge_measured(text_measures(_packed(docs, text, host), "_text").drop("_text"), "_source", host_limit)
    added = [RESERVED, *VERDICTS]
    return judged.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in added], *added)


def _packed(docs: DataFrame, text: str, host: str) -> DataFrame:
    """Text, host and the whole row as one struct, so that no column of the input can clash with one made here."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.col(f"`{text}`").alias("_text"), F.col(f"`{host}`").alias("_source"), F.struct(*columns).alias("_row"))


def judge_measured(measured: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Judge rows that ``text_measures`` measured, with or without their texts.

    The rows are written once to the shared scratch folder and read twice, for
    the hosts and for the join back.
    """
    failed = F.array_compact(F.array(*[F.when(_fails(rule), F.lit(rule)) for rule in HOST_RULES]))
    return _verdicts(scratch_table(measured.withColumn("_failed", failed), "measured"), host, host_limit)


def _verdicts(measured: DataFrame, host: str, host_limit: float) -> DataFrame:
    """Join the hosts' verdicts back to measured documents."""
    bad = F.array_compact(F.array(*[F.when(F.col(f"{rule}_rate") > host_limit, F.lit(rule)) for rule in HOST_RULES]))
    lookup = host_rates(measured, host).select(
        F.when(F.col("host").isNull(), F.lit("n")).otherwise(F.concat(F.lit("h"), F.col("host"))).alias("_host"),
        F.col("n_docs").alias("_n"), bad.alias("_bad"),
    )
    key = F.when(F.col(host).isNull(), F.lit("n")).otherwise(F.concat(F.lit("h"), F.col(host)))
    joined = join_hot(measured.withColumn("_host", key), lookup, "_host", "_n")
    blamed = F.array_intersect("_failed", "_bad")
    return joined.select(
        *[c for c in measured.columns if c not in ("_failed", *VERDICTS)],
        base_failed().alias("base_failed"),
        F.col("_failed").alias("failed_rules"),
        blamed.alias("host_failed_rules"),
        (~base_failed() & (F.size(blamed) == 0)).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that ``judge`` keeps, with their columns unchanged."""
    judged = judge_measured(text_measures(_packed(docs, text, host), "_text").drop("_text"), "_source")
    return judged.filter("kept").select("_row.*")
