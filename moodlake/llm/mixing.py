"""Mixing sources to target weights by Pareto order sampling, on DataFrame expressions alone.

Targets: every source gets words by its weight, at most ``cap`` times its own;
what exceeds that is shared again by weight. Within a source, a size class
(documents whose sizes have the same power of two) has an expected number of
copies, lower for larger documents, so that no source is filled by a few of
them; the whole part of that number is certain, the rest is the inclusion
probability of one more copy. Every document draws random odds from a hash,
divided by its inclusion odds (the Pareto ranking variable); the documents of
a source are taken in that order until its words reach the target.

The order is cut without sorting a source: ranks are counted in about
sqrt(documents) buckets per source, only the bucket in which the target is
reached is sorted, and the cut is a rank value. Whether a document is taken is then a
function of its row, its class and its source's cut, so texts are not shuffled
for it. Sources (not documents) pass through one task when weights are dealt.

Defined results: NULL and empty texts have size 0 and are never taken; a NULL
source is a source of its own, last in order; rows repeated with the same id
and size have the same rank and are taken together; rows without an id have
ranks of their own, by their place in the input, which reruns over the same
files share; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import join_hot, scratch_table, words

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
SEED = 20_240_601
# A size class twice as large has this many times the expected copies.
DAMPING = 0.92


def _coded(source: Column) -> Column:
    """A key that sorts by code point, NULL last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("h"), source))


def _size_class(size: Column) -> Column:
    return F.when(size <= 0, F.lit(-1)).otherwise(F.floor(F.log2(size.cast("double"))).cast("int"))


def _level(total: Column, limit: Column, weight: Column, part: list[str], tie: str) -> Column:
    """The level at which min(weight x level, limit) adds up to ``total`` within ``part``; NULL if all are at their limit."""
    by = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.when(weight > 0, limit / weight), F.col(tie))
    before = F.coalesce(F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    return F.when(weight > 0, (total - before) / rest)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """From ``key``, ``source_size`` per source: adds ``target``."""
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("key"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    one = sizes.withColumn("_w", weight).withColumn("_limit", cap * F.col("source_size"))
    one = one.withColumn("_total", share * F.sum("source_size").over(Window.partitionBy(F.lit(0))))
    one = one.withColumn("_at", _level(F.col("_total"), F.col("_limit"), F.col("_w"), [], "key"))
    below = F.when(F.col("_at") < F.col("_limit") / F.col("_w"), F.col("_at"))
    one = one.withColumn("_level", F.max(below).over(Window.partitionBy(F.lit(0))))
    return one.withColumn(
        "target", F.when(F.col("_level").isNull(), F.col("_limit")).otherwise(F.least("_limit", F.col("_w") * F.col("_level")))
    ).drop("_w", "_limit", "_total", "_at", "_level")


def _plan(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source and size class: certain copies, inclusion probability, target."""
    strata = scratch_table(sized.groupBy("key", "class").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")
    ), "strata")
    sources = targets(
        strata.groupBy("key").agg(F.sum("words").alias("source_size"), F.sum("n").alias("source_docs")), weights, share, cap
    )
    plan = strata.join(sources, "key")
    plan = plan.withColumn("_w", F.when(F.col("words") > 0, F.pow(F.lit(DAMPING), F.col("class")) * F.col("words")).otherwise(0.0))
    plan = plan.withColumn("_limit", cap * F.col("words"))
    plan = plan.withColumn("_at", _level(F.col("target"), F.col("_limit"), F.col("_w"), ["key"], "class"))
    below = F.when(F.col("_at") < F.col("_limit") / F.col("_w"), F.col("_at"))
    plan = plan.withColumn("_level", F.max(below).over(Window.partitionBy("key")))
    taken = F.when(F.col("_level").isNull(), F.col("_limit")).otherwise(F.least("_limit", F.col("_w") * F.col("_level")))
    copies = F.when(F.col("words") > 0, F.least(F.lit(float(cap)), taken / F.col("words"))).otherwise(0.0)
    plan = plan.withColumn("copies", copies).withColumn("whole", F.floor("copies").cast("long"))
    plan = plan.withColumn("chance", F.col("copies") - F.col("whole"))
    sure = F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("key"))
    return plan.select(
        "key", F.concat_ws(":", "class", "key").alias("stratum"), "n", "source_size", "source_docs", "target", "whole", "chance",
        (F.col("target") - sure).alias("room"),
    )


def _rank(row_id: Column, size: Column, place: Column, seed: int) -> tuple[Column, Column]:
    """Pareto rank mapped to 0..1 (NULL without a chance), and what settles equal ranks. NULLs do not enter the hash."""
    draw = F.xxhash64(F.lit(seed), row_id, size, place)
    u = (F.pmod(draw, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) * (1 - F.col("chance")) / F.col("chance")
    return F.when(F.col("chance") > 0, odds / (1 + odds)), F.xxhash64(F.lit(seed + 1), row_id, size, place)


def mix(
    docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE, cap: float = CAP, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: the struct ``row`` with its columns, ``size``, ``source_size``, ``target``, ``copies``.

    Drop the text column beforehand by ``sized`` where it is not needed in the result.
    """
    return mix_sized(sized(docs, id_col, source, text), weights, share, cap, seed)


def sized(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Rows packed for ``mix_sized``: struct ``row``, ``id``, ``size``, ``key`` and ``class``."""
    columns = [c for c in docs.columns if keep_text or c != text]
    return docs.select(
        F.struct(*columns).alias("row"), F.col(id_col).alias("id"), F.size(words(text)).cast("long").alias("size"),
        _coded(F.col(source)).alias("key"),
    ).withColumn("class", _size_class(F.col("size")))


def mix_sized(
    packed: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED,
) -> DataFrame:
    """Mix rows packed by ``sized``."""
    # Rows without an id are told apart by their place, which is written with them.
    place = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    rows = scratch_table(packed.withColumn("stratum", F.concat_ws(":", "class", "key")).withColumn("place", place), "sized")
    lean = rows.select("id", "size", "place", "key", "stratum")
    plan = scratch_table(_plan(rows.select("key", "class", "size"), weights, share, cap), "mix_plan")
    rank, tie = _rank(F.col("id"), F.col("size"), F.col("place"), seed)
    lookup = plan.drop("key")
    drawn = join_hot(lean, lookup, "stratum", "n").withColumn("rank", rank).filter("rank IS NOT NULL")
    drawn = drawn.withColumn("tie", tie).withColumn("buckets", F.ceil(F.sqrt("source_docs")))
    drawn = drawn.withColumn("bucket", F.floor(F.col("rank") * F.col("buckets")))
    counted = drawn.groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
    so_far = F.sum("words").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    crossing = counted.withColumn("upto", so_far).filter("upto > room").groupBy("key").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("at")
    ).select("key", F.col("at.bucket").alias("bucket"), "at.before")
    last = drawn.join(crossing, ["key", "bucket"])
    run = Window.partitionBy("key").orderBy("rank", "tie").rowsBetween(Window.unboundedPreceding, -1)
    # A document belongs to the mix if more than half of it lies before the target.
    last = last.withColumn("upto", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)) + F.col("size") / 2)
    cut = last.filter("upto <= room").groupBy("key").agg(F.max(F.struct("rank", "tie")).alias("cut"))
    cuts = crossing.join(cut, "key", "left").select(
        F.col("key").alias("_key"), F.col("cut.rank").alias("cut_rank"),
        F.col("cut.tie").alias("cut_tie"), F.col("bucket").alias("cut_bucket"), F.lit(True).alias("is_cut"),
    )
    final = scratch_table(
        plan.join(cuts, F.col("key") == F.col("_key"), "left").drop("key", "_key", "room"), "mix_cuts"
    )
    joined = join_hot(rows, final, "stratum", "n").withColumn("rank", rank).withColumn("tie", tie)
    bucket = F.floor(F.col("rank") * F.ceil(F.sqrt("source_docs")))
    chosen = (
        F.when(F.col("rank").isNull(), F.lit(False))
        .when(F.col("is_cut").isNull(), F.lit(True))
        .when(bucket != F.col("cut_bucket"), bucket < F.col("cut_bucket"))
        .when(F.col("cut_tie").isNull(), F.lit(False))
        .otherwise(F.struct("rank", "tie") <= F.struct(F.col("cut_rank").alias("rank"), F.col("cut_tie").alias("tie")))
    )
    return joined.select("row", "size", "source_size", "target", (F.col("whole") + chosen.cast("long")).alias("copies"))


def repeat(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: each document as many times as it has copies, columns unchanged."""
    mixed = mix(docs, id_col, source, text).filter("copies > 0")
    return mixed.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("_copy")).select("row.*")
