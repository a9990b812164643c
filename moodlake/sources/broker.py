"""The message broker: option mapping for reading and writing one topic.

The connector is a separate package (``spark-sql-kafka``) named at submit time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Fixed value: the topic posts travel on.
TOPIC = "social_sentiment"


def source_options(
    servers: str,
    topic: str = TOPIC,
    starting_offsets: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``max_offsets`` caps a micro-batch (unset: none;
    choose it by the scorer's rate); ``min_partitions`` splits broker partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Writer options: all replicas acknowledge, order kept, small batching delay."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
        "kafka.linger.ms": "10",
        "kafka.batch.size": "32768",
    }


def read_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(servers, **options)).load()


def read_batch(spark: SparkSession, servers: str, **options) -> DataFrame:
    """The whole topic as a table, for reprocessing."""
    options = source_options(servers, max_offsets=None, **options)
    return spark.read.format("kafka").options(**options).load()


def write_batch(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Publish ``value``. A failed send fails and repeats the task; no row is skipped."""
    messages.select("value").write.format("kafka").options(**sink_options(servers, topic)).save()


def write_stream(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> DataStreamWriter:
    return (
        messages.select("value").writeStream.format("kafka")
        .options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )
