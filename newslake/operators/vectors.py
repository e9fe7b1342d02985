"""The vector table: rows to store, upsert by several writers, current state.

The table is a set of data folders under a commit log (``sources/commits.py``), each with one folder per hash bucket of the URL, and a Bloom filter
of its URLs beside it. A batch reads only the buckets that hold a URL the filters suspect to be its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions import text, times
from newslake.functions.vectors import has_dimension
from newslake.operators import url_filter
from newslake.operators.embed import DIMENSION
from newslake.schemas import VECTOR_ROW
from newslake.session import DENSE, setting, settle
from newslake.sources import commits

VERSION = "version"
BUCKET = "bucket"
DATA = "data"
FILTER = "filter"
BUCKETS = 16  # a table keeps the number it was made with
MOST_FOLDERS = 24
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
ROW_GROUP = 16 * 1024 * 1024  # bytes a task holds for each open bucket
WRONG_SIZE = "vector has the wrong dimension"


def with_payload(articles: DataFrame, ingested_at: Column) -> DataFrame:
    """Article fields plus ``url`` and ``ingested_at``."""
    url = F.coalesce(text.or_none(F.col("url")), F.lit(""))
    return articles.withColumns({"url": url, "ingested_at": ingested_at})


def article_points(articles: DataFrame, ingested_at: Column) -> DataFrame:
    """One point per article, keyed by URL or text; input has ``vector``."""
    rows = with_payload(articles, ingested_at).withColumns(
        {
            "id": text.article_id(F.col("url"), F.col("content")),
            "published_at": times.iso(F.col("published_at").try_cast("timestamp")),
            "full_content": F.col("content"),
            "chunk_index": F.lit(None).cast("int"),
        }
    )
    return rows.select(*VECTOR_ROW.fieldNames())


def chunk_points(chunks: DataFrame, ingested_at: Column) -> DataFrame:
    """One point per chunk, keyed by URL and chunk index; input has ``vector``."""
    rows = with_payload(chunks, ingested_at).withColumns(
        {
            "id": text.chunk_id(F.col("url"), F.col("full_content"), F.col("chunk_index")),
            "published_at": times.iso(F.col("published_at").try_cast("timestamp")),
        }
    )
    return rows.select(*VECTOR_ROW.fieldNames())


def split_by_dimension(points: DataFrame, dimension: int = DIMENSION) -> tuple[DataFrame, DataFrame]:
    """Points that fit the table, and those that do not."""
    fits = has_dimension(F.col("vector"), dimension)
    return points.where(fits), points.where(~fits)


def bucket_of(url: Column, key: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a row: by URL, by id without one. Rows with one id have one URL, so they share a bucket."""
    return F.pmod(F.xxhash64(F.coalesce(text.or_none(url), key)), F.lit(buckets)).cast("int")


def _write(points: DataFrame, root: str) -> tuple[str, list[int]]:
    """A new data folder with one folder per bucket, and the filter of its URLs: its name, and the buckets that have rows. Not part of the table until committed.

    Each task writes its rows where they are, with all its buckets open at once: rows that carry whole texts and vectors are neither
    shuffled nor sorted. Chunks of a text stand together, so the copies of the text they carry are stored once a page.
    """
    name = uuid.uuid4().hex
    path = f"{root}/{DATA}/{name}"
    rows = points.withColumn(BUCKET, bucket_of(F.col("url"), F.col("id")))
    # One more than the buckets: a task that reaches the limit sorts the rest of its rows.
    with setting(points.sparkSession, OPEN_FILES, str(BUCKETS + 1)):
        rows.write.option("compression", DENSE).option("parquet.block.size", ROW_GROUP).partitionBy(BUCKET).parquet(path)
    schema = T.StructType([*VECTOR_ROW.fields, T.StructField(BUCKET, T.IntegerType())])
    written = points.sparkSession.read.schema(schema).parquet(path)
    words = url_filter.url_filter(written, F.col(BUCKET)).sortWithinPartitions("bucket", "word")
    words.write.parquet(f"{root}/{FILTER}/{name}")
    return name, [r[BUCKET] for r in written.select(BUCKET).distinct().collect()]


def upsert(points: DataFrame, root: str, batch: int, writer: str = "batch") -> int:
    """Store points as a writer's batch. Ids must be unique within it.

    Plain Parquet has no MERGE: the newest commit of an id holds its current row. Several writers may store at the
    same time, each with batch numbers of its own; a batch stored again replaces itself and keeps its place.
    """
    folder, buckets = _write(points, root)
    return commits.commit(points.sparkSession, root, folder, writer, batch, buckets)


def _rows(spark: SparkSession, root: str, folders: list[commits.Folder], buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of data folders with their ``version``; with ``buckets``, only these buckets' folders are listed and read."""
    schema = T.StructType([*VECTOR_ROW.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])
    out = None
    for f in folders:
        base = f"{root}/{DATA}/{f.path}"
        wanted = None if buckets is None else sorted(set(buckets) & set(f.buckets))
        if not f.buckets or wanted == []:
            continue
        paths = [base] if wanted is None else [f"{base}/{BUCKET}={b}" for b in wanted]
        part = spark.read.schema(T.StructType(schema.fields[:-1])).option("basePath", base).parquet(*paths)
        part = part.withColumn(VERSION, F.lit(f.order).cast("long"))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def all_versions(
    spark: SparkSession, root: str, buckets: Sequence[int] | None = None, besides: tuple[str, int] | None = None
) -> DataFrame:
    """Every stored version; an absent table is empty.

    ``buckets`` limits reading to these; ``besides`` leaves out what a (writer, batch) stored, for its own replay.
    """
    live = commits.state(spark, root).folders.values()
    return _rows(spark, root, [f for f in live if (f.writer, f.batch) != besides], buckets).drop(BUCKET)


def buckets_of(articles: DataFrame) -> list[int]:
    """Buckets that rows with a URL fall into: at most ``BUCKETS`` numbers."""
    url = text.or_none(F.col("url"))
    found = articles.where(url.isNotNull()).select(bucket_of(F.col("url"), url).alias(BUCKET)).distinct()
    return [r[BUCKET] for r in found.collect()]


def stored_among(spark: SparkSession, root: str, articles: DataFrame, besides: tuple[str, int] | None = None) -> DataFrame:
    """The URLs of ``articles`` that are stored, exactly.

    The filters of the live folders name the suspects; stored URLs are read only in buckets that have one, so a batch of new
    articles reads filters and nothing else. ``besides`` as in ``all_versions``.
    """
    live = [f for f in commits.state(spark, root).folders.values() if f.buckets and (f.writer, f.batch) != besides]
    buckets = buckets_of(articles) if live else []
    if not buckets:
        return spark.createDataFrame([], "url string")
    filters = spark.read.schema(url_filter.SCHEMA).parquet(*[f"{root}/{FILTER}/{f.path}" for f in live])
    asked = url_filter.keyed(articles, bucket_of(F.col("url"), F.col("url")))
    suspected = settle(url_filter.suspects(asked, filters.where(F.col("bucket").isin(buckets))), "suspects")
    hit = [r.bucket for r in suspected.select("bucket").distinct().collect()]
    return _rows(spark, root, live, hit).select("url").join(suspected.select("url"), "url", "left_semi")


def newest_versions(points: DataFrame, name: str = "superseded") -> DataFrame:
    """Current row of each id.

    Only ids and versions are aggregated to find the ids stored more than once.
    These are few in normal use, so the wide rows are filtered by a broadcast
    and never shuffled; were they many, the planner would shuffle instead.
    """
    repeated = (
        points.groupBy("id")
        .agg(F.max(VERSION).alias("_newest"), F.min(VERSION).alias("_oldest"))
        .where("_newest > _oldest")
        .select("id", "_newest")
    )
    old = settle(repeated, name)
    stale = (points["id"] == old["id"]) & (points[VERSION] < old["_newest"])
    return points.join(old, stale, "left_anti")


def current(spark: SparkSession, root: str) -> DataFrame:
    """Current rows of the table. A single folder, as after a compaction, holds nothing superseded."""
    live = list(commits.state(spark, root).folders.values())
    rows = _rows(spark, root, live).drop(BUCKET)
    return rows if len(live) < 2 else newest_versions(rows)


def compact(spark: SparkSession, root: str) -> None:
    """Merge all folders into one that holds the current rows, and swap them in one commit.

    Readers and writers go on meanwhile: what is committed in between stays beside the merged folder.
    """
    live = list(commits.state(spark, root).folders.values())
    if len(live) < 2:
        return
    merged = newest_versions(_rows(spark, root, live).drop(BUCKET)).drop(VERSION)
    folder, buckets = _write(merged, root)
    commits.replace(spark, root, live, folder, buckets)


def keep_few_folders(spark: SparkSession, root: str, most: int = MOST_FOLDERS) -> None:
    """Compact once more than ``most`` folders are live; one that lost to another writer is left to the next batch."""
    if len(commits.state(spark, root).folders) > most:
        try:
            compact(spark, root)
        except commits.Conflict:
            pass
