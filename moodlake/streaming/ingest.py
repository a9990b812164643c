"""Folder of CSV files -> broker messages, as a stream that keeps rejects and counts.

Each micro-batch is tagged once and staged; messages, rejects and counts are written from the stage, so the files are read
once. A batch repeated after a failure replaces what it wrote before.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from moodlake.operators.ingest import messages, normalise, observe_counts, tag_rejects
from moodlake.session import scratch_scope, scratch_table
from moodlake.sources.csv_files import stream_csv
from moodlake.streaming.enrich import start

COUNTS = "batch_id bigint, read bigint, accepted bigint, rejected bigint"


def split_staged(rows: DataFrame, counts: Observation) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of rows that are read, tagged and counted in one pass; inside a ``scratch_scope`` the stage goes with it."""
    staged = scratch_table(observe_counts(tag_rejects(rows), counts), "tagged")
    return staged.filter("reject_reason IS NULL").drop("reject_reason"), staged.filter("reject_reason IS NOT NULL")


def follow(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    name: str | None = None,
    encoding: str = "UTF-8",
    max_files: int | None = None,
    default_ts: Column | None = None,
    send: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Take in new CSV files: ``out/messages``, ``out/rejects`` and ``out/counts``, a folder per micro-batch in each.

    ``send`` gets the messages instead of ``out/messages``, for a broker; a repeated batch is then sent again
    (``without_replays`` on the other side leaves those out).
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        counts = Observation("ingest")
        with scratch_scope(spark):
            valid, rejects = split_staged(batch, counts)
            posts = messages(normalise(valid, default_ts))
            if send:
                send(posts)
            else:
                posts.write.mode("overwrite").text(f"{out}/messages/batch_id={batch_id}")
            rejects.write.mode("overwrite").json(f"{out}/rejects/batch_id={batch_id}")
            seen = spark.createDataFrame([(json.dumps({"batch_id": batch_id, **counts.get}),)], "value string")
            seen.coalesce(1).write.mode("overwrite").text(f"{out}/counts/batch={batch_id}")

    rows = stream_csv(spark, path, encoding=encoding, max_files=max_files)
    return start(rows.writeStream.foreachBatch(store), checkpoint, trigger, name)


def progress(spark: SparkSession, out: str) -> DataFrame:
    """``batch_id``, ``read``, ``accepted`` and ``rejected`` of every stored micro-batch."""
    text = spark.read.text(f"{out}/counts/*")
    return text.select(F.from_json("value", COUNTS).alias("c")).select("c.*")
