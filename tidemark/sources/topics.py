"""Kafka topic readers. The connector is a jar the cluster provides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(
    servers: str, topic: str, *, streaming: bool, max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True
) -> dict[str, str]:
    """Connector options for a bounded or an unbounded read, from the earliest offset.

    Nothing is held back and lost offsets fail the query, unless asked for otherwise: a cap on
    offsets per trigger must exceed the arrival rate, or the stream falls behind for good.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if not streaming:
        return {**options, "endingOffsets": "latest"}
    options |= {
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.session.timeout.ms": "30000",
        "kafka.request.timeout.ms": "40000",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def _message_columns(df: DataFrame) -> DataFrame:
    # (partition, offset) is the arrival order: the tie-break for equal event times.
    return df.select(
        "value",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    options = topic_options(servers, topic, streaming=False)
    return _message_columns(spark.read.format("kafka").options(**options).load())


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    options = topic_options(
        servers,
        topic,
        streaming=True,
        max_offsets_per_trigger=max_offsets_per_trigger,
        fail_on_data_loss=fail_on_data_loss,
    )
    return _message_columns(spark.readStream.format("kafka").options(**options).load())
