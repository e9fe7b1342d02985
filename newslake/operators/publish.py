"""Rows as keyed messages for other services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions import times
from newslake.functions.text import or_none

KEEP_NULLS = {"ignoreNullFields": "false"}


def as_json(df: DataFrame, *columns: str) -> Column:
    """The row as JSON: times as ISO text with microseconds, nulls written out."""
    names = columns or tuple(df.columns)

    def field(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return times.iso(F.col(name).cast("timestamp")).alias(name)
        return F.col(name)

    return F.to_json(F.struct(*[field(n) for n in names]), KEEP_NULLS)


def refined_messages(refined: DataFrame, *keep: str) -> DataFrame:
    """Refined articles for the topic that the embedding stream reads."""
    fields = [c for c in refined.columns if c not in keep]
    return refined.select(*keep, as_json(refined, *fields).alias("value"))


def article_key(link: Column, title: Column, clock: Column, index: Column) -> Column:
    """Message key: the link, or title, time and place on the page without one."""
    made = F.concat_ws("_", F.coalesce(title, F.lit("")), clock, index.cast("string"))
    return F.coalesce(or_none(link), made)
