"""Lake layout and pruning, and the SQL tool."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from newslake.operators import news, sqltool, trades
from newslake.schemas import REFINED_ARTICLE, SILVER_TRADE
from newslake.sources import lake


@pytest.fixture(scope="module")
def refined_root(spark):
    from newslake.session import scratch_path

    root = scratch_path(spark, "test-refined")
    times = ["2026-01-27T00:10:00Z", "2026-01-27T15:00:00Z", "2026-01-27T15:59:59Z", "bad"]
    raw = spark.createDataFrame(
        [(t, f"l{i}", "body", "coinness", 50) for i, t in enumerate(times)],
        "published_at string, link string, content string, source string, content_length int",
    )
    anchor = F.lit("2026-02-02 03:04:05").cast("timestamp")
    lake.write_hours(news.refine(raw, anchor=anchor), root)
    return root


def test_folders_are_zero_padded_and_hold_no_partition_columns(spark, refined_root):
    assert os.path.isdir(f"{refined_root}/year=2026/month=01/day=27/hour=15")
    assert os.path.isdir(f"{refined_root}/year=2026/month=02/day=02/hour=03")
    inside = spark.read.parquet(f"{refined_root}/year=2026/month=01/day=27/hour=15")
    assert "hour" not in inside.columns and "min" in inside.columns
    table = lake.scan(spark, refined_root, REFINED_ARTICLE)
    assert {r.month for r in table.collect()} == {1, 2}
    assert {r.content_length for r in table.collect()} == {50}


def test_slices(spark, refined_root):
    def links(**part):
        return sorted(r.link for r in lake.scan_slice(spark, refined_root, **part).collect())

    assert links(year=2026, month=1, day=27, hour=15) == ["l1", "l2"]
    assert links(year=2026, month=1, day=27, hour=0) == ["l0"]
    assert links(day=27) == ["l0", "l1", "l2"]
    assert links() == ["l0", "l1", "l2", "l3"]
    assert links(year=1999) == []
    path = lake.slice_path("r", year=2026, month=1, day=27, hour=15)
    assert path == "r/year=2026/month=01/day=27/hour=15/*.parquet"


def test_slices_prune_partitions_and_columns(spark, refined_root):
    plan = lake.scan_slice(spark, refined_root, month=1, hour=15)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text and "hour" in text
    assert "content_length" not in text.split("ReadSchema")[1]


def test_a_full_slice_lists_its_own_folder_only(spark, refined_root):
    one = lake.scan_slice(spark, refined_root, year=2026, month=1, day=27, hour=0)
    listed = one.inputFiles()
    assert listed and all("/month=01/day=27/hour=00/" in name for name in listed)
    assert lake.newest_hour(spark, refined_root) == (2026, 2, 2, 3)


def test_probe_and_missing_lake(spark, refined_root, folder):
    assert lake.slice_exists(spark, refined_root, 2026, 1, 27, 0)
    assert not lake.slice_exists(spark, refined_root, 2026, 1, 27, 1)
    nowhere = folder("nowhere")
    assert not lake.slice_exists(spark, nowhere, 2026, 1, 27, 1)
    assert lake.scan(spark, nowhere, REFINED_ARTICLE).count() == 0


def test_a_hot_hour_is_split_over_tasks(spark, folder):
    """Most rows in one hour must not mean one task for them."""
    root = folder("hot")
    rows = spark.range(200_000).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER_TRADE[:7]],
        F.timestamp_seconds(F.lit(1769526000)).alias("received_at"),
        F.lit(2026).alias("year"), F.lit(1).alias("month"), F.lit(27).alias("day"),
        F.lit(15).alias("hour"), F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        lake.write_hours(rows, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = os.listdir(f"{root}/year=2026/month=01/day=27/hour=15")
    assert len([f for f in files if f.endswith(".parquet")]) > 1


GUARD = [
    ("SELECT AVG(price) AS avg_price FROM trades", True),
    ("  select 1", True),
    ("WITH t AS (SELECT 1 AS x) SELECT x FROM t", True),
    ("SELECT price AS created_at, 1 AS updated_at FROM trades", True),
    ("SELECT 'it''s a drop', \"delete\" FROM trades -- insert", True),
    ("SELECT `price` FROM trades /* alter */", True),
    ("DELETE FROM trades", False),
    ("DROP TABLE trades", False),
    ("INSERT INTO trades SELECT 1", False),
    ("SELECT 1; DROP TABLE trades", False),
    ("WITH t AS (SELECT 1) INSERT INTO trades SELECT * FROM t", False),
    ("SELECT * FROM parquet.`/etc/x`", False),
    ("SELECT * FROM `text` . `/etc/passwd`", False),
    ("SELECT reflect('java.lang.System', 'exit', 0)", False),
    ("SHOW TABLES", False),
    ("", False),
]


@pytest.mark.parametrize("sql, allowed", GUARD)
def test_guard(sql, allowed):
    assert sqltool.is_read_only(sql) is allowed


def test_guard_as_column(spark):
    rows = spark.createDataFrame(GUARD, "sql string, wanted boolean")
    wrong = rows.where(sqltool.read_only(F.col("sql")) != F.col("wanted"))
    assert wrong.collect() == []


@pytest.fixture(scope="module")
def silver_root(spark):
    from newslake.session import scratch_path

    root = scratch_path(spark, "test-silver")
    at = F.timestamp_seconds(F.lit(1769526000) + F.col("id"))
    rows = spark.range(4).select(
        F.col("id").alias("trade_id"), F.lit("BTCUSDT").alias("symbol"),
        (F.col("id") * 1.5).alias("price"), F.lit(2.0).alias("quantity"),
        (F.col("id") * 3.0).alias("amount"), F.lit("BUY").alias("side"),
        at.alias("trade_time"), at.alias("received_at"),
        F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"),
        F.hour(at).alias("hour"),
    )
    lake.write_hours(rows, root)
    return root


def test_sql_answers(spark, silver_root):
    sql = "SELECT avg(price) AS p, max(trade_time) AS t, NULL AS n FROM trades WHERE hour = 15"
    answer = json.loads(sqltool.query_trades_text(spark, sql, silver_root))
    assert answer == [{"p": 2.25, "t": "2026-01-27T15:00:03.000000+00:00", "n": None}]
    assert sqltool.query_trades_text(spark, "SELECT * FROM trades WHERE price < 0", silver_root) == "[]"


def test_sql_answers_are_whole_and_in_order(spark, silver_root):
    sql = "SELECT id FROM (SELECT explode(sequence(1, 10001)) AS id) CROSS JOIN (SELECT 1 FROM trades LIMIT 1) ORDER BY id DESC"
    answer = json.loads(sqltool.query_trades_text(spark, sql, silver_root))
    assert [r["id"] for r in answer] == list(range(10001, 0, -1))


def test_recent_reads_the_last_hours_only(spark, silver_root):
    recent = trades.recent(lake.scan(spark, silver_root, SILVER_TRADE), lake.newest_hour(spark, silver_root))
    assert recent.count() == 4
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(trade_time" in plan


def test_sql_errors_are_text(spark, silver_root):
    def ask(sql):
        return sqltool.query_trades_text(spark, sql, silver_root)

    assert ask("DROP TABLE trades") == sqltool.REJECTED
    assert ask("SELECT nothing FROM trades").startswith("Error: ")
    assert ask("SELECT FROM WHERE").startswith("Error: ")
    assert ask("SELECT CAST('x' AS INT) FROM trades").startswith("Error: ")
    record = sqltool.query_trades(spark, "SELECT nothing FROM trades", silver_root).first().record
    assert record.startswith("Error: ")


def test_sessions_are_isolated(spark, silver_root):
    sqltool.query_trades(spark, "SELECT 1 AS x", silver_root).collect()
    assert not spark.catalog.tableExists("trades")
    session = sqltool.isolated_session(spark)
    with pytest.raises(Exception):
        session.sql(f"SELECT * FROM parquet.`{silver_root}`")


def test_micro_batches_are_sliced_and_replayed(spark):
    from newslake.session import scratch_path

    root = scratch_path(spark, "test-batches")

    def batch(number, *rows):
        raw = spark.createDataFrame([(t, link, "body", "coinness", 4) for t, link in rows],
                                    "published_at string, link string, content string, source string, content_length int")
        lake.write_hours(news.refine(raw, anchor=F.lit("2026-02-02 03:04:05").cast("timestamp")), root, number)

    batch(0, ("2026-01-27T15:00:00Z", "a"), ("Tue, 27 Jan 2026 00:10:00 +0000", "midnight"))
    batch(1, ("2026-01-27T15:30:00Z", "b"))
    batch(0, ("2026-01-27T15:00:00Z", "a"), ("Tue, 27 Jan 2026 00:10:00 +0000", "midnight"))

    def links(hour):
        return sorted(r.link for r in lake.scan_slice(spark, root, year=2026, month=1, day=27, hour=hour).collect())

    assert links(15) == ["a", "b"] and links(0) == ["midnight"] and links(1) == []
    assert lake.scan(spark, root, REFINED_ARTICLE).count() == 3
    assert lake.slice_exists(spark, root, 2026, 1, 27, 0) and not lake.slice_exists(spark, root, 2026, 1, 27, 1)
    assert os.path.isdir(f"{root}/year=2026/month=01/day=27/hour=15/batch=1")
