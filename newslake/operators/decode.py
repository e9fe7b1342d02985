"""JSON decoding with malformed records set aside instead of lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.once import computed_once
from newslake.schemas import CORRUPT, RAW_ARTICLE

MALFORMED = "malformed JSON"


def parse(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the decoded struct ``data`` and the flag ``malformed``.

    Anything that is not one JSON object of the schema is malformed: broken
    text, text after the object, arrays, scalars and mistyped fields.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    data = F.from_json("value", with_corrupt, options)
    ends = F.col("value").rlike(r"\}\s*\z")
    bad = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull() | ~ends
    decoded = computed_once(df, "data", data)
    return decoded.withColumn("malformed", F.coalesce(bad, F.lit(True)))


def valid_only(df: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Decode and drop malformed records; the rest of the batch survives."""
    return good(parse(df, schema), schema, *keep)


def good(parsed: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """The records of a parsed frame that are whole, field by field."""
    return parsed.where(~F.col("malformed")).select(*keep, *[f"data.{f}" for f in schema.fieldNames()])


def fixed_schema(df: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Decode without dropping: a malformed record becomes a row of nulls."""
    data = F.when(~F.col("malformed"), F.col("data"))
    return parse(df, schema).withColumn("data", data).select(
        *keep, *[f"data.{f}" for f in schema.fieldNames()]
    )


def raw_record(value: Column) -> Column:
    """A record that could not be decoded, wrapped as ``{"_raw": ...}``."""
    return F.to_json(F.struct(value.alias("_raw")))


def quarantine(df: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """The malformed records, wrapped for the dead-letter table."""
    return bad(parse(df, schema), *keep)


def bad(parsed: DataFrame, *keep: str) -> DataFrame:
    """The malformed records of a parsed frame, wrapped."""
    wrapped = raw_record(F.col("value")).alias("original_data")
    return parsed.where("malformed").select(*keep, wrapped, F.lit(MALFORMED).alias("error_msg"))


def backfill(df: DataFrame, schema: T.StructType = RAW_ARTICLE) -> DataFrame:
    """Give the frame every expected column; the missing ones are null."""
    have = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in have}
    return df.withColumns(missing) if missing else df
