"""Ordered records: any number of rows as numbered files of JSON lines, with a manifest.

An answer in the order of its statement, or the turns of every conversation, may be longer than one task or the driver
holds. Rows are numbered by a range sort and written by many tasks, ``rows_per_file`` to a file; file n holds the places
from n * rows_per_file + 1 on. With keys, each key's rows stand together, and the manifest says where: one row a key, however
long it is. A slice opens only the files that its places lie in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators.position import block_of, numbered

ROWS_PER_FILE = 100_000
# Microseconds survive the way through text.
_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_PLACES = [T.StructField("place", T.LongType()), T.StructField("file", T.LongType())]


def write_ordered(df: DataFrame, path: str, order: list[str], keys: list[str] | None = None, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write all rows in order of ``keys`` and ``order``, which together should be unique; ties stand in any order.

    ``path/records`` holds the lines, ``path/manifest`` one row a key: first place and number of rows. Null keys are a key. No row is
    left out: null columns are written as nulls.
    """
    keys = keys or []
    placed = numbered(df, [], [*keys, *order], "place").withColumn("file", block_of(F.col("place"), rows_per_file))
    filed = placed.repartition("file").sortWithinPartitions("file", "place")
    filed.write.options(ignoreNullFields="false", **_FORMATS).partitionBy("file").json(f"{path}/records")
    counted = placed.groupBy(*keys).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    counted.withColumn("rows_per_file", F.lit(rows_per_file).cast("long")).write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with their ``place`` and ``file``, in no particular order."""
    return spark.read.schema(T.StructType([*schema.fields, *_PLACES])).options(**_FORMATS).json(f"{path}/records")


def places(spark: SparkSession, path: str, schema: T.StructType, first: int, rows: int) -> DataFrame:
    """The rows at the places from ``first`` on, in order; fewer at the end."""
    per_file = manifest(spark, path).select("rows_per_file").first()
    if per_file is None or rows < 1:
        return records(spark, path, schema).drop("file").limit(0)
    low, high = ((at - 1) // per_file.rows_per_file for at in (first, first + rows - 1))
    inside = F.col("file").between(low, high) & F.col("place").between(first, first + rows - 1)
    return records(spark, path, schema).where(inside).drop("file").orderBy("place")


def page(spark: SparkSession, path: str, schema: T.StructType, number: int, rows: int) -> DataFrame:
    """Page ``number``, from 0, of ``rows`` rows."""
    return places(spark, path, schema, number * rows + 1, rows)
