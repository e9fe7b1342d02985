"""Counts that a run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ["success", "failed", "skipped"]


def ingest_metrics(loaded: DataFrame, processed: DataFrame, path: str | None = None) -> DataFrame:
    """One row about an ingest.

    ``loaded`` holds the articles read (``content``), ``processed`` one row per
    article stored (``n_chunks``). Articles with text that were not stored were
    skipped as duplicates.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    has_text = F.coalesce((F.length("content") > 0).cast("long"), zero)
    read = loaded.select(
        one.alias("loaded"), has_text.alias("texts"), zero.alias("stored"), zero.alias("chunks")
    )
    kept = processed.select(
        zero.alias("loaded"), zero.alias("texts"), one.alias("stored"),
        F.col("n_chunks").cast("long").alias("chunks"),
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), zero)

    columns = [
        F.when(total("loaded") == 0, "no_data").otherwise("success").alias("status"),
        total("loaded").alias("articles_loaded"),
        total("stored").alias("articles_processed"),
        (total("texts") - total("stored")).alias("articles_skipped"),
        total("chunks").alias("chunks_uploaded"),
    ]
    if path is not None:
        columns.append(F.lit(path).alias("target_path"))
    return read.unionAll(kept).agg(*columns)


def feed_counts(articles: DataFrame, status: str = "status") -> DataFrame:
    """Articles per source and crawl result, one column per result, and a total."""
    counts = articles.groupBy("source").pivot(status, STATUSES).count().na.fill(0, STATUSES)
    total = sum((F.col(s) for s in STATUSES[1:]), F.col(STATUSES[0]))
    return counts.withColumn("total", total)
