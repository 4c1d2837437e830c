"""Streams of wire messages, each row with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """Subscribe to a topic; needs the Kafka connector jar.

    ``maxOffsetsPerTrigger`` bounds a micro-batch after a long stop, and ``minPartitions`` splits a
    topic partition that holds more than its share over several tasks.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def file_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str = "value binary", **options: str
) -> DataFrame:
    """The same stream from files that land in a folder; ``maxFilesPerTrigger`` bounds a micro-batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
