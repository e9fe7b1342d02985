"""Lake tables derived from the given tables, written once per session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions import text
from newslake.operators import news, trades, vectors
from newslake.operators.dedup import one_per_id
from newslake.operators.embed import HashedWords, with_vectors
from newslake.plans import stand_ins as si
from newslake.schemas import SILVER_TRADE
from newslake.session import scratch_path
from newslake.sources import commits, lake

DIMENSION = 256

_built: dict[tuple[str, str, str], str] = {}
_tables: dict[str, DataFrame] = {}


def _once(
    spark: SparkSession, sf_dir: str, kind: str, build: Callable[[str], None], mark: str = "_SUCCESS"
) -> str:
    """Path of a derived table; built again if its folder is gone."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key in _built:
        try:
            spark.read.text(f"{_built[key]}/{mark}")
            return _built[key]
        except AnalysisException:
            del _built[key]
    path = scratch_path(spark, kind)
    build(path)
    _built[key] = path
    return path


def silver_root(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        decoded = trades.decode_trades(si.trade_messages(spark, sf_dir))
        lake.write_hours(trades.silver(decoded, anchor=si.anchor()), path)

    return _once(spark, sf_dir, "silver", build)


def bronze_root(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        decoded = trades.decode_trades(si.trade_messages(spark, sf_dir))
        lake.write_hours(trades.bronze(decoded, anchor=si.anchor()), path)

    return _once(spark, sf_dir, "bronze", build)


def refined_root(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        refined = news.refine(si.spread_articles(spark, sf_dir), anchor=si.anchor())
        lake.write_hours(refined, path)

    return _once(spark, sf_dir, "refined", build)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver trades as a table. The table object is kept with its list of
    files, which a catalog would otherwise hold."""
    si.use_utc(spark)
    root = silver_root(spark, sf_dir)
    if root not in _tables:
        _tables[root] = lake.scan(spark, root, SILVER_TRADE)
    return _tables[root]


def newest_trade_hour(spark: SparkSession, sf_dir: str) -> tuple[int, ...] | None:
    return lake.newest_hour(spark, silver_root(spark, sf_dir))


def vector_root(spark: SparkSession, sf_dir: str) -> str:
    """Vector table of the refined articles, one row per article."""

    def build(path: str) -> None:
        refined = news.refine(si.spread_articles(spark, sf_dir), "doc_id", anchor=si.anchor())
        articles = news.with_content(refined).withColumn(
            "url", text.article_url(F.col("link"), F.lit(None).cast("string"))
        )
        unique = one_per_id(articles, "doc_id")
        embedded = with_vectors(unique, HashedWords(DIMENSION))
        vectors.upsert(vectors.article_points(embedded, si.anchor().cast("string")), path, 0)

    return _once(spark, sf_dir, "vectors", build, f"{commits.LOG}/{commits.file_name(0)}")


def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    return vectors.current(spark, vector_root(spark, sf_dir)).drop(vectors.VERSION)
