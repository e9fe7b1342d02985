"""Hits to context and references, and briefs that combine news with trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.text import NO_TITLE, or_none
from newslake.operators.position import block_of, numbered
from newslake.sources import ordered

# Separator of context entries and the two fallback texts.
RULE = "\n\n---\n\n"
NOTHING_FOUND = "관련 뉴스를 찾을 수 없습니다."
SEARCH_FAILED = "뉴스 검색 중 오류가 발생했습니다."

TURNS_PER_PAGE = 64


def entry(title: Column, content: Column) -> Column:
    """One context entry: bracketed title, line break, text."""
    named = F.coalesce(or_none(title), F.lit(NO_TITLE))
    return F.concat(F.lit("["), named, F.lit("]\n"), F.coalesce(content, F.lit("")))


def context(hits: DataFrame) -> DataFrame:
    """Context text per question, in rank order. A group holds k hits at most,
    because ``hits`` come from a top-k search."""
    line = F.struct("rank", entry(F.col("title"), F.col("content")).alias("text"))
    ordered = F.sort_array(F.collect_list(line))
    joined = F.array_join(F.transform(ordered, lambda x: x["text"]), RULE)
    return hits.groupBy("question_id").agg(
        joined.alias("context"), F.count("*").alias("n_hits")
    )


def references(hits: DataFrame, *call: str) -> DataFrame:
    """Reference list per question over all its searches, in call and rank order.

    Hits found by two searches are listed twice. The list is bounded by k per
    search.
    """
    item = F.struct(
        *call, "rank", "title", "url", "source", "published_at", "score"
    )
    ordered = F.sort_array(F.collect_list(item))
    kept = F.transform(
        ordered,
        lambda x: F.struct(
            *[x[f].alias(f) for f in ("title", "url", "source", "published_at", "score")]
        ),
    )
    return hits.groupBy("question_id").agg(kept.alias("reference_news"))


def context_or_default(questions: DataFrame, contexts: DataFrame) -> DataFrame:
    """Every question with its context, or a fixed text without hits.

    A question whose ``error`` is set failed to be searched and says so.
    """
    fallback = F.when(F.col("error").isNotNull(), SEARCH_FAILED).otherwise(NOTHING_FOUND)
    return questions.join(contexts, "question_id", "left").select(
        "question_id",
        F.coalesce("context", fallback).alias("context"),
        F.coalesce("n_hits", F.lit(0).cast("long")).alias("n_hits"),
    )


def brief(contexts: DataFrame, statistics: DataFrame) -> DataFrame:
    """Contexts next to trade statistics, a one-row table read as scalars."""
    values = {c: statistics.select(c).scalar() for c in statistics.columns}
    return contexts.withColumns(values)


def transcript(turns: DataFrame, turns_per_page: int = TURNS_PER_PAGE) -> DataFrame:
    """Conversations as ordered pages of a fixed number of turns.

    Even a conversation that is most of the table is assembled by many tasks, and
    no page grows with it. Pages in order of ``page`` are the whole transcript.
    """
    listed = turns.withColumn("_row", F.monotonically_increasing_id())
    placed = numbered(listed, ["conv_id"], ["turn", "_row"], "_place")
    page = block_of(F.col("_place"), turns_per_page)
    lines = F.sort_array(F.collect_list(F.struct("_place", "turn", "role", "text")))
    shown = F.transform(
        lines, lambda x: F.struct(*[x[f].alias(f) for f in ("turn", "role", "text")])
    )
    return placed.groupBy("conv_id", page.alias("page")).agg(shown.alias("turns"))


def write_transcripts(turns: DataFrame, path: str, rows_per_file: int = ordered.ROWS_PER_FILE) -> None:
    """Every conversation as one transcript of any length: its turns in order, next to each other in numbered files, and
    one manifest row that says where it begins and how many turns it has. Turns with equal numbers stand in any order."""
    ordered.write_ordered(turns, path, ["turn"], ["conv_id"], rows_per_file)


def read_transcript(spark: SparkSession, path: str, schema: T.StructType, conv_id: int | str) -> DataFrame:
    """One conversation in order; opens only the files it lies in."""
    found = ordered.manifest(spark, path).where(F.col("conv_id") == F.lit(conv_id)).first()
    return ordered.places(spark, path, schema, found["first"] if found else 1, found["rows"] if found else 0)


def transcripts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All turns with ``position`` in their conversation, from 1, and its ``n_turns``."""
    r = ordered.records(spark, path, schema).alias("r")
    m = ordered.manifest(spark, path).alias("m")
    joined = r.join(m, F.col("r.conv_id").eqNullSafe(F.col("m.conv_id")))
    position = (F.col("place") - F.col("first") + 1).alias("position")
    return joined.select("r.conv_id", position, F.col("rows").alias("n_turns"), *[f"r.{c}" for c in schema.names if c != "conv_id"])
