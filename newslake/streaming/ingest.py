"""Refined articles to the vector table, as a batch job and as a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslake.functions import text, times
from newslake.operators import chunk, decode, dedup, embed, metrics, news, publish, vectors
from newslake.schemas import REFINED_MESSAGE
from newslake.session import DENSE, settle
from newslake.sources import commits, lake
from newslake.sources.messages import DEAD_LETTER_TOPIC
from newslake.streaming.runs import each_batch, kept, send

BATCH_WRITER, STREAM_WRITER = "batch", "stream"


def new_articles(loaded: DataFrame, stored: DataFrame, *order: str) -> DataFrame:
    """Articles to embed: with text, first of their id, URL not stored yet."""
    unique = settle(dedup.one_per_id(news.with_content(loaded), *order), "unique", DENSE)
    return dedup.not_stored_batch(unique, stored)


def _vector_or_fail() -> Column:
    failed = F.raise_error(F.concat(F.lit("embedding failed: "), F.col("error")))
    return F.when(F.col("error").isNotNull(), failed.cast("array<float>")).otherwise(
        F.col("vector")
    )


def ingest(
    spark: SparkSession,
    loaded: DataFrame,
    root: str,
    version: int,
    embedder: embed.Embedder,
    ingested_at: Column,
    order: Sequence[str],
    chunker: Callable[[Column], Column] = chunk.separated_chunks,
    path: str | None = None,
) -> DataFrame:
    """Chunk, embed and store the new articles of a slice; return run metrics.

    The chunked new articles are settled before the embedder runs, so that the
    duplicate check is not repeated and the metrics refer to exactly the rows that
    were stored. A chunk that cannot be embedded fails the run, which is then
    repeated as a whole; what it stored before is replaced, not doubled.
    """
    articles = loaded.withColumn("url", F.coalesce("link", F.lit("")))
    unique = settle(dedup.one_per_id(news.with_content(articles), *order), "unique", DENSE)
    fresh = dedup.not_stored(unique, settle(vectors.stored_among(spark, root, unique, (BATCH_WRITER, version)), "seen-urls"))
    pieces = settle(fresh.withColumn("_chunks", chunker(F.col("content"))), "pieces", DENSE)
    rows = chunk.chunk_rows(pieces, F.col("_chunks")).drop("_chunks")
    done = embed.with_vectors(rows, embedder).withColumn("vector", _vector_or_fail())
    vectors.upsert(vectors.chunk_points(done, ingested_at), root, version, BATCH_WRITER)
    stored = pieces.select(F.size("_chunks").alias("n_chunks"))
    return metrics.ingest_metrics(articles, stored, path)


def ingest_slice(
    spark: SparkSession,
    refined_root: str,
    vector_root: str,
    version: int,
    embedder: embed.Embedder,
    ingested_at: Column,
    chunker: Callable[[Column], Column] = chunk.separated_chunks,
    **part: int | None,
) -> DataFrame:
    """One hour of the refined lake, or all of it without parts. Running the same
    hour again stores nothing new."""
    loaded = lake.scan_slice(spark, refined_root, **part)
    return ingest(
        spark, loaded, vector_root, version, embedder, ingested_at,
        ["published_at", "title", "content"], chunker, lake.slice_path(refined_root, **part),
    )


def write_vectors(
    batch: DataFrame,
    batch_id: int,
    root: str,
    embedder: embed.Embedder,
    dimension: int,
    waits: Sequence[float] | None = None,
    servers: str | None = None,
) -> None:
    """One micro-batch of refined articles to the vector table, whole articles.

    Order of the checks: cheap ones first, the embedder only for what remains.
    What fails goes to the dead letters and does not stop the batch.
    """
    spark = batch.sparkSession
    if commits.state(spark, root).committed(STREAM_WRITER, batch_id):
        return  # a replay: the commit is the last thing a batch does
    with kept(decode.parse(batch, REFINED_MESSAGE)) as parsed:
        _embed_parsed(parsed, batch_id, root, embedder, dimension, waits, servers)


def _embed_parsed(parsed: DataFrame, batch_id: int, root: str, embedder: embed.Embedder, dimension: int, waits: Sequence[float] | None, servers: str | None) -> None:
    spark = parsed.sparkSession
    decoded = decode.good(parsed, REFINED_MESSAGE, "arrived_at", "value")
    url = text.article_url(F.col("link"), F.col("url"))
    articles = decoded.withColumn("url", url)
    unique = settle(dedup.one_per_id(news.with_content(articles), "arrived_at", "value"), "unique", DENSE)
    fresh = dedup.not_stored(unique, settle(vectors.stored_among(spark, root, unique), "seen-urls"))
    done = settle(embed.with_vectors(fresh, embedder, waits=waits), "embedded", DENSE)
    stored_at = times.iso(F.current_timestamp())
    points = vectors.article_points(done.where("error IS NULL"), stored_at)
    fitting, misfits = vectors.split_by_dimension(points, dimension)

    failed_at = F.unix_timestamp().cast("string")
    malformed = decode.bad(parsed).withColumn("failed_at", failed_at)
    failed = done.where("error IS NOT NULL").select(
        F.col("value").alias("original_data"), F.col("error").alias("error_msg"),
        failed_at.alias("failed_at"),
    )
    wrong_size = misfits.select(
        F.to_json(F.struct("id", "url", "title", "content")).alias("original_data"),
        F.lit(vectors.WRONG_SIZE).alias("error_msg"), failed_at.alias("failed_at"),
    )
    letters = malformed.unionByName(failed).unionByName(wrong_size)
    letters.write.mode("overwrite").parquet(lake.batch_path(f"{root}_dead_letter", batch_id))
    if servers:
        send(letters.select(publish.as_json(letters).alias("value")), DEAD_LETTER_TOPIC, servers)
    vectors.upsert(fitting, root, batch_id, STREAM_WRITER)
    vectors.keep_few_folders(spark, root)


def start(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    embedder: embed.Embedder,
    dimension: int = embed.DIMENSION,
    bounded: bool = False,
    waits: Sequence[float] | None = None,
    servers: str | None = None,
) -> StreamingQuery:
    """Embed what arrives. With ``servers``, dead letters are also published."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_vectors(batch, batch_id, root, embedder, dimension, waits, servers)

    return each_batch(messages, handle, checkpoint, bounded)
