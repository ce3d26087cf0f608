"""Kafka topic source and sink. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from candlemill.streaming.drain import start_drain


def topic_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = True,
    min_partitions: int | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Reader options. ``starting`` counts on the first run only; the checkpoint rules later ones.

    ``min_partitions`` splits a topic partition over several tasks; ``max_offsets`` bounds one
    micro-batch.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **choices) -> DataFrame:
    """The topic as a stream with a binary ``value`` column."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **choices)).load()


def stream_to_topic(
    messages: DataFrame, servers: str, checkpoint: str, topic: str | None = None
) -> StreamingQuery:
    """Keyed messages to a topic, or to the one each row names in a ``topic`` column."""
    options = {"kafka.bootstrap.servers": servers}
    if topic:
        options["topic"] = topic
    return start_drain(messages.writeStream.format("kafka").options(**options), checkpoint)
