"""Keep an expensive column from being computed again in every filter on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add or replace a column so that later filters on it stay above it.

    The optimizer moves a filter below the projection that makes its column, and
    then computes the column in both places, for each mention. A one-element
    ``explode`` cannot be passed.
    """
    others = [c for c in df.columns if c != name]
    made = df.select(*others, F.explode(F.array(column)).alias(name))
    return made.select(*df.columns) if name in df.columns else made
