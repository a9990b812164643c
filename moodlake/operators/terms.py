"""Exact term statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moodlake.functions.text import tokens
from moodlake.session import scratch_table


def tokenised(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    return df.withColumn("tokens", tokens(text))


def term_stats(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """term, tf, df, idf over all rows with text, with idf = ln((N + 1) / (df + 1)).

    Each row yields its tokens twice, once all and once the distinct ones, so
    document frequency needs no shuffle by document; the one shuffle is by
    term, after partial counts. Only single tokens leave the row, never the
    array next to each of them. A third yield, one NULL per row with text,
    counts N in the same pass: the counts go to the scratch folder once, and N
    is read from there instead of from the texts again.
    """
    words = df.select(tokens(text).alias("words")).filter(F.col("words").isNotNull())
    row_mark = F.array(F.lit(None).cast("string"))
    yields = F.array("words", F.array_distinct("words"), row_mark)
    single = (
        words.select(F.posexplode(yields).alias("kind", "words")).select("kind", F.explode("words").alias("term"))
    )
    counts = scratch_table(
        single.groupBy("term").agg(
            *[F.count_if(F.col("kind") == i).alias(c) for i, c in enumerate(("tf", "df", "rows"))]
        ),
        "terms",
    )
    n = counts.filter(F.col("term").isNull()).agg(F.sum("rows")).scalar()
    idf = F.log((n + 1) / (F.col("df") + 1)).alias("idf")
    return counts.filter(F.col("term").isNotNull()).select("term", "tf", "df", idf)
