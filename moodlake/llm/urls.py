"""URL filter: given rules first, then rules mined from labelled URLs.

Given rules name a host and a path; the longest that fits decides. URLs no rule
fits are judged by association rules: FP-growth finds combinations of URL tokens
that labelled pages share, and a combination becomes a rule if enough labelled
pages hold it (support) and most of them are labelled bad (confidence). A rule
whose part does as well is dropped. Rules are matched through an inverted index from a rule's rarest
token to the rule: a URL's tokens join it, and the rule fires if the URL has its other tokens, too.

Defined results: a NULL URL, or one without ``://``, has an empty host and path
and no tokens; repeated rows are each judged; NULL labels do not teach; an
empty table gives an empty result, and without labels nothing is mined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import scratch_table

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
BAD = "=bad"
# Beyond this many index rows the index is no longer broadcast.
BROADCAST_ROWS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def split_url(url: Column | str = "url") -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path."""
    column = F.col(url) if isinstance(url, str) else url
    rest = F.coalesce(F.regexp_extract(column, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct(rule, verdict) of the longest rule that fits, else NULL."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(url: Column | str = "url") -> Column:
    """Distinct tokens: scheme, host and its parents, path parts by depth with digits made alike, names of query parameters."""
    column = F.col(url) if isinstance(url, str) else url
    host, path = split_url(column)
    labels = F.split(host, r"\.")
    parents = F.array(*[
        F.when(F.size(labels) > n, F.concat(F.lit("under:"), F.array_join(F.slice(labels, -n, n), "."))) for n in (1, 2, 3)
    ])
    parts = F.transform(
        F.array_remove(F.split(F.regexp_replace(path, r"[0-9]+", "0"), "/"), ""),
        lambda p, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), p),
    )
    names = F.transform(F.regexp_extract_all(column, F.lit(r"[?&]([^=&#?]+)="), F.lit(1)), lambda n: F.concat(F.lit("query:"), n))
    every = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(column, r"^([^:/?#]*)://", 1)), F.concat(F.lit("host:"), host)),
        F.array_compact(parents), parts, names,
    )
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


RULE = "rule_id bigint, tokens array<string>, confidence double, support double, parts array<struct<n:bigint,members:array<string>>>"


def closed_tokens(rows: DataFrame, least: float) -> DataFrame:
    """``token``, ``name``, ``n``: tokens that stand in at least ``least`` of the rows (``rid``, ``items``); those that stand in the same
    rows share a name, the smallest of them. There are at most tokens per row / share wanted of them."""
    each = rows.select("rid", F.explode("items").alias("token"))
    found = each.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rid")).alias("a"), F.bit_xor(F.xxhash64("rid", F.lit(1))).alias("b"),
    ).filter(F.col("n") >= least)
    found = scratch_table(found, "tokens")
    names = found.groupBy("n", "a", "b").agg(F.min("token").alias("name"))
    return scratch_table(found.join(names, ["n", "a", "b"]).select("token", "name", "n"), "closed_tokens")


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``rule_id``, ``tokens``, ``confidence``, ``support``, ``parts`` from all labelled rows; ``bad`` is boolean.

    Tokens that stand in the same labelled rows are mined as one, so a page with many parameters of its own adds one token
    and not all their combinations. Such a rule stands for those with any of these tokens in their place: ``parts`` holds, for
    each of its ``tokens``, all that may stand for it, the rarest part first.
    """
    rows = labelled.filter(F.col(bad).isNotNull()).select(tokens(url).alias("items"), F.col(bad).alias("bad")).filter(F.size("items") > 0)
    rows = scratch_table(rows.withColumn("rid", F.monotonically_increasing_id()), "labelled_urls")
    total = rows.count()
    if not total:
        return rows.sparkSession.createDataFrame([], RULE)
    names = closed_tokens(rows, min_support * total)
    items = rows.select("rid", "bad", F.explode("items").alias("token")).join(F.broadcast(names), "token", "left")
    items = items.groupBy("rid", "bad").agg(F.collect_set("name").alias("items"))
    items = scratch_table(items.select(
        F.when(F.col("bad"), F.array_union("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items")
    ), "transactions")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.filter((F.size("consequent") == 1) & (F.element_at("consequent", 1) == BAD))
    found = scratch_table(found.select(
        F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    ), "rules")
    # A rule says nothing new if one with a token less is as sure.
    shorter = found.select(
        "rule_id", "confidence", F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("part")
    ).select("rule_id", "confidence", F.xxhash64("part").alias("part_id"))
    known = found.select(F.col("rule_id").alias("part_id"), F.col("confidence").alias("part_confidence"))
    idle = shorter.join(known, "part_id").filter("part_confidence >= confidence").select("rule_id").distinct()
    kept = found.join(idle, "rule_id", "left_anti")
    members = names.groupBy("name").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("token")).alias("members"))
    parts = kept.select("rule_id", F.explode("tokens").alias("name")).join(members, "name")
    parts = parts.groupBy("rule_id").agg(F.sort_array(F.collect_list(F.struct("n", "members"))).alias("parts"))
    return kept.join(parts, "rule_id").select("rule_id", "tokens", "confidence", "support", "parts")


def matched(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs for which a mined rule fires: ``url``, ``rule_id`` (the smallest).

    A rule is indexed under the tokens of its rarest part only; a URL that has one of them is tested for the others in its own row.
    """
    index = scratch_table(rules.select("rule_id", "parts.members", F.explode(F.col("parts")[0]["members"]).alias("token")), "rule_index")
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    held = urls.select(url).distinct().select(url, tokens(url).alias("held"))
    each = held.select(url, "held", F.explode("held").alias("token"))
    fires = F.forall("members", lambda part: F.arrays_overlap(part, F.col("held")))
    return each.join(index, "token").filter(fires).groupBy(url).agg(F.min("rule_id").alias("rule_id"))


def judge(
    pages: DataFrame, labelled: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES,
    min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Struct ``row`` with the columns of ``pages``, and ``host``, ``path``, ``rule``, ``verdict``, ``mined_rule``.

    ``labelled`` holds ``url`` and the boolean ``bad``. Only distinct URLs are
    shuffled for matching, and those for which a rule fires come back by URL.
    """
    mined = mine(labelled.select(F.col(url).alias("_url"), "bad"), "_url", "bad", min_support, min_confidence)
    packed = pages.select(F.struct(*pages.columns).alias("row"), F.col(url).alias("_url"))
    hits = matched(packed.select("_url"), mined, "_url")
    host, path = split_url("_url")
    judged = packed.join(hits, "_url", "left").select("row", host.alias("host"), path.alias("path"), "rule_id")
    judged = judged.withColumn("given", fitting_rule(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("rule_id").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "row", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", learned).alias("verdict"),
        F.when(F.col("given").isNull(), F.col("rule_id")).alias("mined_rule"),
    )
