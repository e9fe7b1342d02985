"""Message streams: topics on a broker, or files of messages in their place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NEWS_TOPICS = ["coindesk-news", "coinness-breaking", "coinness-newsroom"]
TRADE_TOPIC = "binance.trades.btcusdt"
REFINED_TOPIC = "news-raw"
DEAD_LETTER_TOPIC = "news-dlq-failed"


def topic_stream(
    spark: SparkSession,
    topics: list[str],
    servers: str,
    max_per_trigger: int | None = None,
    starting: str = "latest",
) -> DataFrame:
    """Subscribe to topics. ``max_per_trigger`` caps the rows of a micro-batch,
    not the rows of the stream: the rest is in the next batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrived_at"),
    )


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same stream from text files holding one message per line."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )
