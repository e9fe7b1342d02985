"""Schemas of the messages that arrive and the tables that are kept."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Raw article as published by the three feeds. The order is the table contract.
RAW_ARTICLE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_length", T.IntegerType()),
        T.StructField("crawled_at", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("news_type", T.StringType()),
    ]
)

# Payload keys differ only by case (t/T, m/M), which a struct cannot hold under
# case-insensitive resolution; a map keeps every key apart.
TRADE_ENVELOPE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("received_at", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    ]
)

PARTITIONS = ["year", "month", "day", "hour"]


def _with_partitions(fields: list[T.StructField]) -> T.StructType:
    return T.StructType(fields + [T.StructField(p, T.IntegerType()) for p in PARTITIONS])


REFINED_ARTICLE = _with_partitions(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_length", T.IntegerType()),
        T.StructField("crawled_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("min", T.IntegerType()),
    ]
)

# Refined article as a message: times are ISO text, a URL may come along.
REFINED_MESSAGE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_length", T.IntegerType()),
        T.StructField("crawled_at", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

BRONZE_TRADE = _with_partitions(
    [
        T.StructField("raw_json", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

SILVER_TRADE = _with_partitions(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("side", T.StringType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

VECTOR_ROW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("source", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("full_content", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("original_data", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("failed_at", T.StringType()),
    ]
)
