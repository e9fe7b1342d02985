"""Search as SQL table functions over a vector table.

* ``search_news(query, n)`` answers one question, a literal or a parameter: the question is embedded once, a relation
  of one row that every task gets, the table is scanned by all tasks and each keeps its n best rows (``TakeOrderedAndProject``). n is 3 if not given.
* ``search_news_of(query, n)`` answers the questions of a table, also lateral: ``FROM asked, LATERAL search_news_of(asked.text, 3)``. Its
  hits were found by ``search.nearest`` in blocks when the function was registered, so a lateral call is an equi join by the
  question's text and no question meets all rows in a join. n above ``most`` of the registration gives ``most`` rows.

Both return rank, id, the article fields ('' if missing) and score. An empty, null or unknown question has no hits in the second one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.vectors import has_dimension
from newslake.operators.embed import Embedder, with_vectors
from newslake.operators.search import ASK_LIMIT, SCORE_DIGITS, SEARCH_LIMIT, search
from newslake.session import settle

FIELDS = ("title", "content", "url", "source", "published_at")
_RETURNS = "rank INT, id STRING, " + ", ".join(f"{f} STRING" for f in FIELDS) + ", score DOUBLE"
_COLUMNS = "rank, id, " + ", ".join(FIELDS) + ", score"


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> double(x) * double(y)), 0D, (total, x) -> total + x)"


def register_search(session: SparkSession, table: DataFrame, embedder: Embedder, dimension: int) -> None:
    """Define ``search_news`` in a session, over a frame of that session with id, vector and the article fields."""
    fields = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in FIELDS]
    size = F.expr(f"sqrt({_dot('vector', 'vector')})").alias("size")
    table.where(has_dimension(F.col("vector"), dimension)).select("id", "vector", size, *fields).createOrReplaceTempView("news_vectors")

    @F.arrow_udf("array<float>")
    def embed_question(texts: pa.Array) -> pa.Array:
        return pa.array(list(embedder(texts)), pa.list_(pa.float32()))

    session.udf.register("embed_question", embed_question)
    score = f"coalesce(round({_dot('vector', 'asked')} / nullif(size * asked_size, 0D), {SCORE_DIGITS}), 0D)"
    session.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION search_news(query STRING, n INT DEFAULT {ASK_LIMIT}) RETURNS TABLE ({_RETURNS})
RETURN SELECT {_COLUMNS}
FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank
      FROM (SELECT id, {', '.join(FIELDS)}, {score} AS score
            FROM news_vectors, (SELECT asked, sqrt({_dot('asked', 'asked')}) AS asked_size
                                FROM (SELECT embed_question(coalesce(query, '')) AS asked))))
WHERE rank <= n""")


def register_questions(session: SparkSession, table: DataFrame, questions: DataFrame, embedder: Embedder, dimension: int, most: int = SEARCH_LIMIT) -> None:
    """Define ``search_news_of`` in a session for the texts of ``questions`` (column ``text``), both frames of that session; equal texts are
    searched once."""
    texts = questions.where("text <> ''").select("text").distinct()
    asked = settle(with_vectors(texts, embedder, "text").select(F.col("text").alias("question_id"), "vector"), "asked")
    settle(search(asked, table, most, dimension, FIELDS), "question-hits").createOrReplaceTempView("news_hits")
    session.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION search_news_of(query STRING, n INT DEFAULT {ASK_LIMIT}) RETURNS TABLE ({_RETURNS})
RETURN SELECT {_COLUMNS} FROM news_hits WHERE question_id = query AND rank <= n""")
