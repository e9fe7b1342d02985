"""Streams over the messages derived from the given tables, run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions import text
from newslake.operators import embed, news, publish, vectors
from newslake.plans import lakes
from newslake.plans import stand_ins as si
from newslake.plans.vector_queries import _ARTICLE_CTES
from newslake.schemas import REFINED_ARTICLE, SILVER_TRADE
from newslake.session import scratch_path, settle
from newslake.sources import lake, messages
from newslake.streaming import ingest, medallion, refine

FILES_PER_BATCH = 4


N_FILES = 8


def topic_files(spark: SparkSession, df: DataFrame, order: str, name: str) -> str:
    """Messages as text files in the order they were sent, in place of a topic."""
    path = scratch_path(spark, name)
    df.repartitionByRange(N_FILES, order).select("value").write.text(path)
    return path


def stream_trade_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows after all micro-batches were written to both layers."""
    topic = topic_files(spark, si.trade_messages(spark, sf_dir), "event_id", "trade-topic")
    root = scratch_path(spark, "medallion")
    stream = messages.file_stream(spark, topic, FILES_PER_BATCH)
    medallion.start(stream, root, f"{root}/checkpoint", bounded=True).awaitTermination()
    rows = lake.scan(spark, medallion.layer_paths(root)["silver"], SILVER_TRADE)
    return si.without_zone(rows).withColumn("amount", F.round("amount", 6))


MEDALLION_SQL = si.with_ctes(
    f"""
SELECT trade_id, symbol, price, quantity, round(amount, 6) AS amount, side, trade_time,
       received_at, {si.parts_of("trade_time")}
FROM silver
""",
    si.EV, si.SILVER,
)


def stream_news_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined articles after all micro-batches. An article without a time lies in
    the hour of its arrival, so its partition is not shown."""
    raw = si.raw_articles(spark, sf_dir)
    value = publish.as_json(raw.drop("doc_id")).alias("value")
    topic = topic_files(spark, raw.select("doc_id", value), "doc_id", "news-topic")
    root = scratch_path(spark, "refine")
    stream = messages.file_stream(spark, topic, FILES_PER_BATCH)
    refine.start(stream, root, f"{root}/checkpoint", bounded=True).awaitTermination()
    rows = lake.scan(spark, f"{root}/refined", REFINED_ARTICLE)
    hour = F.when(F.col("published_at").isNull(), -1).otherwise(F.col("hour"))
    return si.without_zone(rows).drop("year", "month", "day", "min").withColumn("hour", hour)


STREAM_REFINE_SQL = si.with_ctes(
    """
SELECT title, link, published_at, content, content_length, crawled_at, source,
       CASE WHEN published_at IS NULL THEN -1 ELSE hour END AS hour
FROM refined
""",
    si.DOC, si.REFINED,
)


def stream_embed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector table after all micro-batches: one whole article per id.

    Which of several articles with one URL arrives first is up to the stream, so each stored row is compared with all
    articles sent, and its vector with that of its own text.
    """
    refined = news.refine(si.spread_articles(spark, sf_dir), "doc_id", anchor=si.anchor())
    sent = publish.refined_messages(refined, "doc_id")
    topic = topic_files(spark, sent, "doc_id", "refined-topic")
    root = scratch_path(spark, "embedded")
    stream = messages.file_stream(spark, topic, FILES_PER_BATCH)
    job = ingest.start(
        stream, f"{root}/vectors", f"{root}/checkpoint",
        embed.HashedWords(lakes.DIMENSION), lakes.DIMENSION, bounded=True,
    )
    job.awaitTermination()
    table = vectors.current(spark, f"{root}/vectors")
    url = F.coalesce(text.article_url(F.col("link"), F.lit(None).cast("string")), F.lit(""))
    known = refined.select(text.article_id(url, F.col("content")).alias("of_id"), F.col("title").alias("of_title"), F.col("content").alias("of_content"))
    same = (F.col("id") == F.col("of_id")) & F.col("title").eqNullSafe(F.col("of_title")) & (F.col("content") == F.col("of_content"))
    again = embed.with_vectors(table.withColumnRenamed("vector", "stored"), embed.HashedWords(lakes.DIMENSION))
    again = settle(again.select("id", "title", "content", "url", "stored", "vector"), "embedded-again")
    checked = again.join(known.distinct(), same, "left")
    return checked.select(
        "id", "url", F.size("stored").alias("dimension"), F.col("of_id").isNotNull().alias("was_sent"), (F.col("stored") == F.col("vector")).alias("vector_fits")
    )


STREAM_EMBED_SQL = si.with_ctes(
    f"SELECT id, url, {lakes.DIMENSION} AS dimension, true AS was_sent, true AS vector_fits FROM article", *_ARTICLE_CTES
)

QUERIES = {
    "stream_trade_medallion": (stream_trade_medallion, MEDALLION_SQL),
    "stream_news_refine": (stream_news_refine, STREAM_REFINE_SQL),
    "stream_embed_upsert": (stream_embed_upsert, STREAM_EMBED_SQL),
}
