"""Approximate distinct counts that add up: one HyperLogLog sketch per group and hour, merged to any span.

A sketch has at most 2**lg_k small registers however many values it saw, is made map-side, and hours are never read again: the
distinct values of a day, a month or all time are the union of their sketches. ``count_distinct`` stays the exact way.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """Standard deviation of an estimate from merged sketches, relative to the count."""
    return 1.04 / sqrt(2**lg_k)


def hourly_sketches(df: DataFrame, keys: list[str], at: Column, value: str, lg_k: int = LG_K) -> DataFrame:
    """(keys, hour, sketch); rows without a time have a null hour, null values are not counted."""
    return df.groupBy(*keys, F.date_trunc("hour", at).alias("hour")).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def merged(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """(by, sketch) of the union; mergeable again."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, name: str = "estimate") -> DataFrame:
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
