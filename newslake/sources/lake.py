"""Hour-partitioned Parquet lake: layout, writes, scans and probes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.schemas import PARTITIONS, REFINED_ARTICLE, SILVER_TRADE
from newslake.session import DENSE, setting
from newslake.sources.files import Files

BATCH = "batch"
WIDTHS = dict(zip(PARTITIONS, (4, 2, 2, 2)))
SMALLEST_TASK = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
SLICE_COLUMNS = ["title", "content", "link", "published_at", "source"]


def padded_parts(df: DataFrame) -> DataFrame:
    """Partition columns as the zero-padded text that names the folders."""
    return df.withColumns({p: F.lpad(F.col(p).cast("string"), WIDTHS[p], "0") for p in PARTITIONS})


def write_hours(df: DataFrame, root: str, batch_id: int | None = None) -> None:
    """Write a table with year/month/day/hour columns to the lake.

    Rows are rebalanced on the hour first: small hours become one file each, and
    an hour that holds most of the rows is split over several tasks instead of
    landing in one. Merging tiny shuffle partitions would not save files here, as
    every hour is a file of its own, and would only write them one after another.

    Without a batch number the rows are appended. A micro-batch has a folder of its
    own below each hour it has rows for, so a slice finds its rows whoever wrote them,
    and a replayed batch replaces its own folders: no row is doubled.
    """
    rows = padded_parts(df).hint("rebalance", *PARTITIONS)
    with setting(df.sparkSession, SMALLEST_TASK, "64k"):
        if batch_id is None:
            rows.write.mode("append").option("compression", DENSE).partitionBy(*PARTITIONS).parquet(root)
        else:
            writer = rows.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer = writer.option("compression", DENSE)
            writer.partitionBy(*PARTITIONS, BATCH).parquet(root)


def batch_path(root: str, batch_id: int) -> str:
    """Folder of one micro-batch in a table without hours."""
    return f"{root}/{BATCH}={batch_id}"


def scan(
    spark: SparkSession, path: str, schema: T.StructType, root: str | None = None
) -> DataFrame:
    """A lake table; an absent or empty folder gives an empty table."""
    try:
        reader = spark.read.schema(schema).option("basePath", root or path)
        return reader.parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def part_filter(
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    hour: int | None = None,
) -> Column:
    """Partition predicate; None is a wildcard, and hour 0 is an hour."""
    wanted = zip(PARTITIONS, (year, month, day, hour))
    condition = F.lit(True)
    for name, value in wanted:
        if value is not None:
            condition = condition & (F.col(name) == value)
    return condition


def slice_folder(
    root: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    hour: int | None = None,
) -> str:
    """Deepest folder that holds the whole slice: the parts given from the left."""
    path = root
    for name, value in zip(PARTITIONS, (year, month, day, hour)):
        if value is None:
            break
        path += f"/{name}={value:0{WIDTHS[name]}d}"
    return path


def scan_part(
    spark: SparkSession, root: str, schema: T.StructType, **part: int | None
) -> DataFrame:
    """A partition slice of an hour-partitioned table.

    Reading starts at the slice's folder, so the folders of other hours are not
    even listed; parts that are given after a wildcard are pruned as usual.
    """
    folder = slice_folder(root, **part)
    return scan(spark, folder, schema, root).where(part_filter(**part))


def scan_slice(spark: SparkSession, root: str, **part: int | None) -> DataFrame:
    """Articles of a partition slice, the five columns that ingest needs."""
    return scan_part(spark, root, REFINED_ARTICLE, **part).select(*SLICE_COLUMNS)


def slice_path(
    root: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    hour: int | None = None,
) -> str:
    """The slice as a path pattern, for reports."""
    shown = [f"{year:04d}" if year is not None else "*"]
    shown += [f"{v:02d}" if v is not None else "*" for v in (month, day, hour)]
    return "/".join([root, *(f"{p}={v}" for p, v in zip(PARTITIONS, shown)), "*.parquet"])


def slice_exists(spark: SparkSession, root: str, year: int, month: int, day: int, hour: int) -> bool:
    """Whether the partition holds data, by one listing of its folder; a failing probe counts as yes, since the
    ingest that follows will report the problem."""
    try:
        return bool(Files(spark, slice_folder(root, year, month, day, hour)).names())
    except Exception:
        return True


def hours(spark: SparkSession, root: str, above: tuple[int, ...] = ()) -> Iterator[tuple[int, ...]]:
    """Partitions of a lake table that hold data, newest first, by stepping down its folders. Only folders are listed, each when it is reached."""
    found = Files(spark, "/".join([root, *(f"{p}={v:0{WIDTHS[p]}d}" for p, v in zip(PARTITIONS, above))])).names()
    if len(above) == len(PARTITIONS):
        if found:
            yield above
        return
    prefix = f"{PARTITIONS[len(above)]}="
    values = sorted((int(n[len(prefix):]) for n in found if n.startswith(prefix) and n[len(prefix):].isdigit()), reverse=True)
    for value in values:
        yield from hours(spark, root, (*above, value))


def newest_hour(spark: SparkSession, root: str) -> tuple[int, ...] | None:
    """Newest partition of a lake table; four listings, however many files it has."""
    return next(hours(spark, root), None)


def trades_view(spark: SparkSession, root: str, name: str = "trades") -> DataFrame:
    """Expose the silver files as a session-local SQL view."""
    table = scan(spark, root, SILVER_TRADE)
    table.createOrReplaceTempView(name)
    return table
