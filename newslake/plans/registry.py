"""All queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newslake.plans import (
    delegated,
    news_queries,
    stream_queries,
    trade_queries,
    vector_queries,
)

_ALL = {
    **trade_queries.QUERIES,
    **news_queries.QUERIES,
    **vector_queries.QUERIES,
    **stream_queries.QUERIES,
    **delegated.QUERIES,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql is not None}
