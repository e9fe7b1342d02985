"""Which articles are new: duplicates inside a batch and against a stored table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import article_id, or_none
from newslake.session import DENSE, settle, without

SALTS = 1024


def stored_urls(stored: DataFrame) -> DataFrame:
    """Distinct URLs of a stored table; a row without a URL matches nothing."""
    return stored.select(or_none(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()


def _first_of_each(articles: DataFrame, keys: list[Column], order: tuple[str, ...]) -> DataFrame:
    """First row of each group.

    Whole articles are written once, with a number each, and never sorted: only keys are counted, and only rows that
    share their key with others are compared, by key, order and number. The minimum is taken before the shuffle, so the copies in a group
    travel as one row per task however many there are. What is given out are the rows less the numbers of all others of their group.
    """
    named = {f"_key{i}": k for i, k in enumerate(keys)}
    rows = settle(articles.withColumns({**named, "_row": F.monotonically_increasing_id()}), "articles", DENSE)
    shared = rows.groupBy(*named).count().where("count > 1").drop("count")
    same = reduce(and_, (F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in named))
    shared = settle(shared, "shared-keys")
    compared = rows.select(*named, *order, "_row").alias("r").join(shared.alias("s"), same, "left_semi")
    first = compared.groupBy(*named).agg(F.min_by("_row", F.struct(*order, "_row")).alias("_row"))
    others = rows.select(*named, "_row").alias("r").join(shared.alias("s"), same, "left_semi").select("_row")
    gone = settle(others.join(first.select("_row"), "_row", "left_anti"), "copies")
    return without(rows, gone, "_row").select(*articles.columns)


def one_per_url(articles: DataFrame, *order: str) -> DataFrame:
    """Keep the first article of each URL; articles without a URL are all kept.

    ``order`` must identify an article: those without a URL are grouped by it
    instead of meeting in one group.
    """
    url = or_none(F.col("url"))
    own = [F.when(url.isNull(), F.col(c)) for c in order]
    return _first_of_each(articles, [url, *own], order)


def one_per_id(articles: DataFrame, *order: str) -> DataFrame:
    """Keep the first article of each stable id: by URL, by text without one."""
    return _first_of_each(articles, [article_id(F.col("url"), F.col("content"))], order)


def _with_salt(articles: DataFrame) -> DataFrame:
    """Join salt: 0 with a URL; spread over many values without one, so that the
    articles without a URL do not all go to one task."""
    absent = or_none(F.col("url")).isNull()
    # From the row itself: a task that is run again must send it to the same place.
    spread = F.pmod(F.xxhash64(*[F.col(c) for c, kind in articles.dtypes if not kind.startswith("map")]), F.lit(SALTS)) + 1
    return articles.withColumn("_salt", F.when(absent, spread).otherwise(F.lit(0).cast("long")))


def not_stored(articles: DataFrame, stored: DataFrame) -> DataFrame:
    """Articles whose URL is not stored yet. No URL means never a duplicate."""
    known = stored_urls(stored).withColumn("_salt", F.lit(0).cast("long"))
    return _with_salt(articles).join(known, ["url", "_salt"], "left_anti").drop("_salt")


def already_stored(articles: DataFrame, stored: DataFrame) -> DataFrame:
    """Articles whose URL is stored, which an ingest skips."""
    return articles.where(or_none(F.col("url")).isNotNull()).join(stored_urls(stored), "url", "left_semi")


def not_stored_batch(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """``not_stored`` for a small settled batch against a large table.

    The batch's URLs select the few stored URLs that matter, so the table is
    scanned for one column and not shuffled when the planner finds the batch small
    enough to broadcast. The URLs found are settled, so the same holds for them and
    the articles stay where they are; large sides are shuffled.
    """
    wanted = batch.select(or_none(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()
    seen = stored.select("url").join(wanted, "url", "left_semi").distinct()
    return not_stored(batch, settle(seen, "seen-urls"))


def find_url(stored: DataFrame, url: str) -> DataFrame:
    """First stored row with this URL. The equality reaches the Parquet scan."""
    return stored.where(F.col("url") == url).limit(1)
