"""Topic source and sink. The connector is a package of the cluster, not of this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tripmill.operators.ingest import keyed_messages


def stream_topic(
    spark: SparkSession, brokers: str, topic: str, starting: str = "latest"
) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )


def read_topic(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """Everything the topic holds, from the earliest offset."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def publish(events: DataFrame, brokers: str, topic: str) -> None:
    """Write events keyed by ride; a failed task is retried by Spark."""
    (
        keyed_messages(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def publish_stream(
    messages: DataFrame, brokers: str, topic: str, checkpoint: str, mode: str = "update"
) -> DataStreamWriter:
    """Write a stream that has a `value` column, and a `key` where order matters."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )
