"""Article refinement, feed union and look-back filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions import text, times
from newslake.functions.once import computed_once
from newslake.operators.decode import backfill
from newslake.schemas import PARTITIONS

LOOKBACK_MINUTES = 720
FEED_LIMIT = 20


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """One table from feeds with different columns, matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def refine(articles: DataFrame, *keep: str, anchor: Column | None = None) -> DataFrame:
    """Raw articles to the refined schema.

    ``content_length`` keeps the length before cleaning. Articles whose time
    cannot be read are kept and land in the anchor's partition.
    """
    raw = backfill(articles)
    published = times.parse_time(F.col("published_at"))
    parts = times.partition_parts(published, anchor)
    minute = F.minute(F.coalesce(published, times.now_or(anchor)))
    return raw.select(
        *keep,
        "title",
        "link",
        published.alias("published_at"),
        text.refined_content(F.col("source"), F.col("content")).alias("content"),
        F.col("content_length").cast("int").alias("content_length"),
        times.parse_time(F.col("crawled_at")).alias("crawled_at"),
        text.source_label(F.col("source"), F.col("news_type")).alias("source"),
        minute.alias("min"),
        *[parts[p].alias(p) for p in PARTITIONS],
    )


def published_after(articles: DataFrame, since: Column, lenient: bool = False) -> DataFrame:
    """Articles published strictly after ``since``.

    An unknown time drops the article, or keeps it when ``lenient``.
    """
    published = times.parse_time(F.col("published_at"))
    recent = published > since
    return articles.where((published.isNull() | recent) if lenient else recent)


def window_start(interval_end: Column, minutes: int = LOOKBACK_MINUTES) -> Column:
    """Start of the look-back window that ends with the crawl interval."""
    return interval_end - F.make_dt_interval(mins=F.lit(minutes))


def latest(articles: DataFrame, n: int | None, *tiebreak: str) -> DataFrame:
    """The newest ``n`` articles of a feed; None means all of them."""
    if n is None:
        return articles
    return articles.orderBy(F.col("published_at").desc_nulls_last(), *tiebreak).limit(n)


def with_content(articles: DataFrame) -> DataFrame:
    """Drop articles without text. Cleaning is not repeated for the check."""
    return computed_once(articles, "content", F.col("content")).where(F.length("content") > 0)


def with_link(articles: DataFrame) -> DataFrame:
    """Drop articles without a link: there is no page to fetch for them."""
    return articles.where(F.length("link") > 0)


def pick_title(extracted: Column, listed: Column) -> Column:
    """Title found on the page, else the listed one, else a placeholder."""
    return F.coalesce(text.or_none(extracted), text.or_none(listed), F.lit(text.NO_TITLE))
