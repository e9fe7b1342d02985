"""Read-only SQL over the ``trades`` view, answered as JSON records."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators.publish import as_json
from newslake.session import settle, use_utc
from newslake.sources import ordered
from newslake.sources.lake import trades_view

# --- fixed values -----------------------------------------------------------
REJECTED = "Error: Only SELECT queries are allowed."
WRITE_WORDS = ["DELETE", "UPDATE", "INSERT", "DROP", "CREATE", "ALTER", "TRUNCATE"]
# -----------------------------------------------------------------------------
# Words that write or run foreign code in Spark SQL but are not listed above.
MORE_WORDS = ["MERGE", "REFLECT", "TRY_REFLECT", "JAVA_METHOD"]
FORMATS = ["parquet", "orc", "json", "csv", "text", "avro", "xml", "jdbc", "binaryfile"]

_LITERAL = r"(?s)'(?:[^'\\]|\\.)*+'|\"(?:[^\"\\]|\\.)*+\"|--[^\n]*+|/\*.*?\*/"
_STARTS = r"(?is)^\s*(SELECT|WITH)\b"
_WRITES = r"(?i)\b(" + "|".join(WRITE_WORDS + MORE_WORDS) + r")\b"
_FILE_RELATION = r"(?i)(?<![\w.])`?(" + "|".join(FORMATS) + r")`?\s*\.\s*`"


def read_only(sql: Column) -> Column:
    """Whether statements may run: SELECT or WITH, no write word as a word of its
    own, no files read by path. Literals and comments do not count."""
    bare = F.regexp_replace(sql, _LITERAL, " ")
    allowed = bare.rlike(_STARTS) & ~bare.rlike(_WRITES) & ~bare.rlike(_FILE_RELATION)
    return F.coalesce(allowed, F.lit(False))


def is_read_only(sql: str) -> bool:
    """``read_only`` for one statement."""
    bare = re.sub(_LITERAL, " ", sql)
    return bool(
        re.search(_STARTS, bare)
        and not re.search(_WRITES, bare)
        and not re.search(_FILE_RELATION, bare)
    )


def isolated_session(spark: SparkSession) -> SparkSession:
    """A session of its own per question: views and settings do not leak, and
    reading files by path is off."""
    session = use_utc(spark.newSession())
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


def _one(session: SparkSession, text: str) -> DataFrame:
    return session.range(1).select(F.lit(text).alias("record"))


def query_trades(spark: SparkSession, sql: str, silver_root: str) -> DataFrame:
    """Run a SELECT on the silver files: one JSON record per result row.

    A rejected or invalid statement gives one row with the error text.
    """
    session = isolated_session(spark)
    if not is_read_only(sql):
        return _one(session, REJECTED)
    try:
        trades_view(session, silver_root)
        result = session.sql(sql)
        return result.select(as_json(result).alias("record"))
    except PySparkException as error:
        return _one(session, f"Error: {error}")


def query_trades_text(spark: SparkSession, sql: str, silver_root: str) -> str:
    """The answer as one JSON array, or an error text; never raises.

    Rows come in the order of the statement, a partition at a time, and none is left
    out: the text is as long as the answer. ``query_trades`` keeps an answer distributed.
    """
    try:
        records = query_trades(spark, sql, silver_root)
        lines = [r["record"] for r in records.toLocalIterator()]
    except Exception as error:
        return f"Error: {error}"
    if len(lines) == 1 and lines[0].startswith("Error: "):
        return lines[0]
    return "[" + ",".join(lines) + "]"


def answer_to_files(spark: SparkSession, sql: str, silver_root: str, path: str, rows_per_file: int = ordered.ROWS_PER_FILE) -> str | None:
    """The answer in the order of its statement as numbered files of JSON lines (column ``record``), read by ``answer_page``.

    Tasks write it; the driver sees no row, however long the answer is. Returns the error text instead of writing if the
    statement is rejected or fails before it runs.
    """
    session = isolated_session(spark)
    if not is_read_only(sql):
        return REJECTED
    try:
        trades_view(session, silver_root)
        result = session.sql(sql)
        lines = result.select(as_json(result).alias("record"), F.monotonically_increasing_id().alias("_row"))
        lines = settle(lines, "answer")
    except PySparkException as error:
        return f"Error: {error}"
    ordered.write_ordered(lines, path, ["_row"], rows_per_file=rows_per_file)
    return None


_RECORD = T.StructType([T.StructField("record", T.StringType())])


def answer_page(spark: SparkSession, path: str, number: int, rows: int) -> DataFrame:
    """``record, place`` of page ``number``, from 0, in order."""
    return ordered.page(spark, path, _RECORD, number, rows)


def answer(spark: SparkSession, path: str) -> DataFrame:
    """``record, place`` of the whole answer."""
    return ordered.records(spark, path, _RECORD).drop("file")
