"""A Bloom filter of stored URLs as a table, probed before the exact check.

A URL falls into one bucket and one 64-bit word of it and sets ``MARKS`` bits there. A filter is a table (bucket, word, bits) of the
words in use: at most one row a URL, and no more than ``WORDS`` rows a bucket however many URLs there are. Filters merge by
``bit_or``. A probe is one equi join by (bucket, word); a URL whose bits are not all set is certainly not stored. With four URLs a
word about one new URL in 700 is still suspected, which only costs its exact check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import or_none
from newslake.operators.dedup import not_stored
from newslake.session import settle

WORDS = 2**24
MARKS = 5
SCHEMA = "bucket int, word long, bits long"


def _bits(url: Column) -> Column:
    marks = F.xxhash64(url, F.lit("marks"))
    out = F.lit(0).cast("long")
    for i in range(MARKS):
        place = F.pmod(F.shiftright(marks, 6 * i), F.lit(64)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def keyed(urls: DataFrame, bucket: Column, words: int = WORDS) -> DataFrame:
    """Distinct present URLs with bucket, word and bits."""
    url = or_none(F.col("url"))
    found = urls.where(url.isNotNull()).select("url", bucket.cast("int").alias("bucket")).distinct()
    word = F.pmod(F.xxhash64("url", F.lit("word")), F.lit(words))
    return found.select("url", "bucket", word.alias("word"), _bits(F.col("url")).alias("bits"))


def merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))


def url_filter(urls: DataFrame, bucket: Column, words: int = WORDS) -> DataFrame:
    """The filter of a table of URLs; empty ones are in no filter."""
    return merged(keyed(urls, bucket, words))


def suspects(asked: DataFrame, filters: DataFrame) -> DataFrame:
    """(url, bucket) of the ``keyed`` URLs that may be stored; all that are stored are among them."""
    words = merged(filters).withColumnRenamed("bits", "held")
    found = asked.join(words, ["bucket", "word"])
    return found.where(F.col("held").bitwiseAND(F.col("bits")) == F.col("bits")).select("url", "bucket")


def not_stored_filtered(articles: DataFrame, stored: DataFrame, filters: DataFrame, bucket: Column, words: int = WORDS) -> DataFrame:
    """``dedup.not_stored`` that compares only suspects with the stored URLs. ``filters`` covers ``stored`` with the same
    bucket and words."""
    asked = settle(suspects(keyed(articles, bucket, words), filters).select("url"), "suspects")
    return not_stored(articles, stored.select("url").join(asked, "url", "left_semi"))
