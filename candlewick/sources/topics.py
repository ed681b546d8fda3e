"""Message topics. The Kafka connector comes with the cluster; file folders give the same envelope in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_topics(spark: SparkSession, servers: str, topics: list[str], batch_messages: int = 10_000_000) -> DataFrame:
    """Envelope stream (topic, event_time, offset, value) of the given topics, at most `batch_messages` in a micro-batch, so that
    a job that was down for long does not take all it missed at once."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", batch_messages)
        .load()
    )
    return stream.select(
        "topic", F.col("timestamp").alias("event_time"), "offset", F.col("value").cast("string").alias("value")
    )


def read_folder(spark: SparkSession, pattern: str, schema: StructType, files: int | None = None) -> DataFrame:
    """Stream of the Parquet files a path pattern matches, at most `files` of them in a micro-batch."""
    stream = spark.readStream.schema(schema)
    return (stream if files is None else stream.option("maxFilesPerTrigger", files)).parquet(pattern)


def write_topics(messages: DataFrame, servers: str, checkpoint: str):
    """Stream rows (topic, key, value) to the topic each row names."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_console(stream: DataFrame, checkpoint: str):
    return (
        stream.writeStream.format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .start()
    )
