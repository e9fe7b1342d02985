"""Bounded, reproducible training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import text_or_empty
from newslake.session import settle

LONGEST = 1 << 15  # bytes of a text to learn from; longer ones are not in a sample
LABEL_BYTES = 12 << 20  # bytes of all texts of a label
SPARE = 4  # times the wanted rows that come to be ranked


def stratified(rows: DataFrame, stratum: Column, per_stratum: int) -> DataFrame:
    """At most ``per_stratum`` rows of each stratum: those whose ids have the smallest hashes.

    ``rows`` must be narrow and hold one row per ``doc_id``. Rows are counted first, and only
    those whose hash lies below a share that leaves about ``SPARE`` times the wanted rows are ranked, so no
    task ranks a whole stratum. The result is written out, so its size is known wherever it is joined.
    """
    rows = rows.withColumn("stratum", stratum)
    share = F.lit(float(SPARE * per_stratum)) / F.col("count")
    shares = settle(rows.groupBy("stratum").count().select("stratum", share.alias("share")), "shares")
    place = F.xxhash64("doc_id").cast("double") / F.lit(2.0**64) + 0.5  # from 0 to 1, in the order of the hashes
    few = rows.alias("r").join(shares.alias("s"), F.col("r.stratum").eqNullSafe(F.col("s.stratum")) & (place <= F.col("s.share")))
    order = Window.partitionBy("stratum").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = few.select("r.*").withColumn("rank", F.row_number().over(order))
    return settle(ranked.where(F.col("rank") <= per_stratum).drop("stratum", "rank"), "sample")


def one_per_id(rows: DataFrame, *values: str) -> DataFrame:
    """One row per non-null id; where rows of an id differ, the largest value of each column."""
    return rows.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(v).alias(v) for v in values)
    )


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """A sample of labelled texts: doc_id, label, text.

    ``labels`` holds doc_id and the label, one row per id. A label has at most ``per_label`` texts, none longer than ``LONGEST`` bytes and
    ``LABEL_BYTES`` in all; they are taken in the order of the ids' hashes. Of several texts of an id the largest is taken; a null text is empty.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sizes = texts.withColumn("size", F.octet_length("text")).where(F.col("size") <= LONGEST).groupBy("doc_id").agg(F.max("size").alias("size"))
    able = settle(labels.join(sizes, "doc_id"), "labelled")
    chosen = stratified(able, F.col(label), per_label)
    sofar = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = chosen.withColumn("sofar", F.sum("size").over(sofar)).where(F.col("sofar") <= LABEL_BYTES)
    found = texts.where(F.octet_length("text") <= LONGEST).join(within.select("doc_id", F.col(label).cast("int").alias("label")), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
