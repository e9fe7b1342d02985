"""Exact cosine top-k of every question over a vector table.

The table is scanned once per block of questions, block after block. Each task scores its rows
against the block with one matrix product per Arrow batch and keeps k rows per
question, so the pairs are never rows of a join. The survivors, at most k per
question and task, are merged by a ranked window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.vectors import has_dimension
from newslake.operators.embed import unit_rows
from newslake.operators.position import block_of, numbered
from newslake.session import scratch_path, settle

# Upper bound of what one block of questions occupies in a task.
BLOCK_BYTES = 64 * 1024 * 1024
# Scores are compared after rounding, so that the order of equal vectors does
# not depend on how a batch was cut; the id decides between equal scores.
SCORE_DIGITS = 9
ASK_LIMIT = 3
SEARCH_LIMIT = 5


def _matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit_rows(values.reshape(-1, dimension))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one question: highest score first, then lowest id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = scores >= cut
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class _Kept:
    """The best rows seen so far for each question of a block."""

    def __init__(self, n_questions: int, k: int):
        self.k = k
        self.floor = np.full(n_questions, -np.inf)
        self.best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n_questions

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take a questions x rows matrix. Rows below a question's k-th score so
        far cannot enter; equal ones may, by their id."""
        open_ = scores >= self.floor[:, None]
        for i in np.flatnonzero(open_.any(axis=1)):
            found = scores[i][open_[i]], ids[open_[i]]
            if self.best[i] is not None:
                found = tuple(np.concatenate(pair) for pair in zip(self.best[i], found))
            self.best[i] = _best(*found, self.k)
            if len(self.best[i][0]) == self.k:
                self.floor[i] = self.best[i][0][-1]


def _score_partition(batches: Iterator[pa.RecordBatch], block, k: int, dimension: int, kind):
    question_ids, questions = block.value
    kept = _Kept(len(question_ids), k)
    step = max(1, BLOCK_BYTES // (8 * max(1, len(question_ids))))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            rows = _matrix(part.column(1), dimension)
            scores = np.nan_to_num(questions @ rows.T, nan=0.0)
            kept.offer(np.round(scores, SCORE_DIGITS), np.array(part.column(0).to_pylist()))
    for question_id, found in zip(question_ids, kept.best):
        if found is not None:
            scores, ids = found
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([question_id] * len(ids), kind[0]),
                    pa.array(ids.tolist(), kind[1]),
                    pa.array(scores, pa.float64()),
                ],
                names=["question_id", "id", "score"],
            )


def _arrow_type(field: T.StructField) -> pa.DataType:
    kinds = {T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.LongType(): pa.int64()}
    return kinds[field.dataType]


def _blocks(asked: DataFrame, per_block: int) -> tuple[DataFrame, int]:
    """Questions in blocks of at most ``per_block`` rows, one folder a block, and the number of blocks."""
    rows = settle(asked.withColumn("_row", F.monotonically_increasing_id()), "questions")
    blocks = -(-rows.count() // per_block)
    placed = numbered(rows, [], ["_row"], "_place") if blocks > 1 else rows.withColumn("_place", F.lit(1).cast("long"))
    path = scratch_path(asked.sparkSession, "question-blocks")
    placed = placed.select("question_id", "vector", (block_of(F.col("_place"), per_block)).alias("_block"))
    placed.write.partitionBy("_block").parquet(path)
    return asked.sparkSession.read.schema(placed.schema).parquet(path), blocks


def block_hits(corpus: DataFrame, block, k: int, dimension: int, schema: T.StructType) -> DataFrame:
    """The k best rows of a corpus (id, vector) for each question of a broadcast block, ranked."""
    kind = (_arrow_type(schema[0]), _arrow_type(schema[1]))
    hits = corpus.mapInArrow(lambda batches: _score_partition(batches, block, k, dimension, kind), schema)
    by_score = Window.partitionBy("question_id").orderBy(F.col("score").desc(), "id")
    return hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def nearest(
    questions: DataFrame,
    table: DataFrame,
    k: int = ASK_LIMIT,
    dimension: int = 1536,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``question_id, id, score, rank`` of the k nearest rows per question.

    ``questions`` has ``question_id`` (unique) and ``vector``, ``table`` has ``id`` and
    ``vector``; ids are unique, strings or integers. Vectors of another dimension
    cannot be compared and belong to the dead letters (``split_by_dimension``).

    Blocks are searched one after another: a block of at most ``block_bytes`` passes through the driver, is broadcast, its hits are
    written to the shared folder, and it is given up before the next. What the driver and the tasks hold does not depend on the
    number of questions.
    """
    spark = questions.sparkSession
    fits = has_dimension(F.col("vector"), dimension)
    per_block = max(1, block_bytes // (8 * dimension))
    asked, blocks = _blocks(questions.where(fits).select("question_id", "vector"), per_block)
    schema = T.StructType(
        [
            T.StructField("question_id", asked.schema["question_id"].dataType),
            T.StructField("id", table.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    ranked = T.StructType([*schema.fields, T.StructField("rank", T.IntegerType())])
    if not blocks:
        return spark.createDataFrame([], ranked)
    corpus = table.where(fits).select("id", "vector")
    path = scratch_path(spark, "hits")
    for b in range(blocks):
        held = asked.where(F.col("_block") == b).select("question_id", "vector").toArrow()
        vectors = _matrix(held.column("vector").combine_chunks(), dimension)
        block = spark.sparkContext.broadcast((held.column("question_id").to_pylist(), vectors))
        del held, vectors
        block_hits(corpus, block, k, dimension, schema).write.mode("append").parquet(path)
        block.destroy()
    return spark.read.schema(ranked).parquet(path)


def search(
    questions: DataFrame,
    table: DataFrame,
    k: int = SEARCH_LIMIT,
    dimension: int = 1536,
    fields: tuple[str, ...] = ("title", "content", "url", "source", "published_at"),
) -> DataFrame:
    """Hits with their article fields; missing fields become ''.

    The hits are files already: they are k per question, so the planner sees their
    size and can find their rows without shuffling the table.
    """
    hits = nearest(questions, table, k, dimension)
    found = table.select("id", *fields).join(hits, "id")
    return found.select(
        "question_id",
        "rank",
        "id",
        *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
