"""Broker stream -> decoded, cleaned, scored posts -> partitioned Parquet."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from moodlake.operators.posts import clean_posts, decode_posts, stored_shape
from moodlake.session import scratch_scope
from moodlake.sources.store import store_batch

Score = Callable[[DataFrame], DataFrame]


def enrich(broker_rows: DataFrame, score: Score, keep_error: bool = True) -> DataFrame:
    """The whole way from ``value`` to the stored shape; batch and stream alike.

    ``score`` adds the scoring columns, e.g. ``lambda df: scoring.score(df, factory)``.
    No step shuffles.
    """
    return stored_shape(score(clean_posts(decode_posts(broker_rows))), keep_error)


def without_replays(broker_rows: DataFrame, within: str = "1 hour") -> DataFrame:
    """A stream of messages in which an id that comes again within this time of its arrival is left out.

    A producer that retries sends messages twice. Arrival is the broker's ``timestamp``, or the time of the micro-batch
    where there is none; ids older than ``within`` leave the state, which so holds the ids of that time only. The state
    is kept with the checkpoint. Messages without an id are all kept.
    """
    arrival = F.col("timestamp") if "timestamp" in broker_rows.columns else F.current_timestamp()
    post_id = F.get_json_object(F.col("value").cast("string"), "$.id")
    key = F.coalesce(F.concat(F.lit("i"), post_id), F.concat(F.lit("r"), F.expr("uuid()")))
    keyed = broker_rows.withColumns({"_key": key, "_arrival": arrival}).withWatermark("_arrival", within)
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrival")


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """A name kept with the checkpoint: restarts find it again, a new checkpoint gets a later one in alphabetical order."""
    path = f"{checkpoint.rstrip('/')}/writer"
    try:
        kept = spark.read.text(path).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept is not None:
        return kept[0]
    name = f"s{time.time_ns() // 1_000_000:014d}-{uuid.uuid4().hex[:12]}"
    spark.createDataFrame([(name,)], "id string").coalesce(1).write.mode("overwrite").text(path)
    return name


def start(
    writer: DataStreamWriter, checkpoint: str, trigger: str | None, name: str | None
) -> StreamingQuery:
    """Start with a checkpoint; without a trigger interval, work off what is there."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def write_stream(
    enriched: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Append to the store. ``trigger=None`` works off what is there and stops.
    Restarting with the same checkpoint resumes."""
    return write_stream_batches(enriched, lambda batch: batch, path, checkpoint, trigger, name)


def write_stream_batches(
    broker_rows: DataFrame,
    to_enriched: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Like ``write_stream`` with batch-only steps, such as scoring each distinct
    text of a micro-batch once.

    Each micro-batch is one commit that carries the checkpoint's id and the
    batch's number; a batch repeated after a failure finds itself committed or
    is stored anew, so no row is stored twice. Scratch tables of the steps go
    once the batch is stored.
    """
    spark = broker_rows.sparkSession
    writer = writer_id(spark, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            store_batch(to_enriched(batch), path, f"{writer}-{batch_id}", (writer, batch_id))

    return start(broker_rows.writeStream.foreachBatch(store), checkpoint, trigger, name)


def run(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query to end; stop it on interrupt or after ``timeout`` seconds.

    True when it ended by itself; its failure is raised.
    """
    try:
        ended = query.awaitTermination(timeout) if timeout else query.awaitTermination() is None
    except KeyboardInterrupt:
        ended = False
    if not ended:
        query.stop()
    return ended
