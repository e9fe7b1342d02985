"""Trade decoding: the edge rows, layers and statistics."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newslake.operators import decode, trades
from newslake.schemas import RAW_ARTICLE, TRADE_ENVELOPE

RECEIVED = "2025-03-04T05:06:08.100000+00:00"
PAYLOAD = {
    "e": "trade", "E": 1741064767251, "s": "BTCUSDT", "t": 4242,
    "p": "61000.50000000", "q": "0.02000000", "T": 1741064767250, "m": False, "M": True,
}


def envelope(drop=(), **changes):
    payload = {k: v for k, v in {**PAYLOAD, **changes}.items() if k not in drop}
    return json.dumps({"source": "binance_ws", "stream": "trade", "symbol": "BTCUSDT",
                       "received_at": RECEIVED, "payload": payload})


def decoded(spark, *values):
    return trades.decode_trades(spark.createDataFrame([(v,) for v in values], "value string"))


def silver_of(spark, value):
    anchor = F.lit("2026-02-02 05:06:07").cast("timestamp")
    row = trades.silver(decoded(spark, value), anchor=anchor)
    row = row.withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))
    return row.first()


def test_worked_example(spark):
    row = silver_of(spark, envelope())
    assert (row.trade_id, row.symbol, row.side) == (4242, "BTCUSDT", "BUY")
    assert (row.price, row.quantity) == (61000.5, 0.02)
    assert row.amount == pytest.approx(1220.01)
    assert row.trade_time == datetime(2025, 3, 4, 5, 6, 7, 250000)
    assert (row.year, row.month, row.day, row.hour) == (2025, 3, 4, 5)


def test_side(spark):
    assert silver_of(spark, envelope(m=True)).side == "SELL"
    assert silver_of(spark, envelope(drop=["m"])).side == "BUY"


def test_missing_values(spark):
    assert silver_of(spark, envelope(drop=["p"])).price == 0.0
    row = silver_of(spark, envelope(drop=["T"]))
    assert row.trade_time is None and (row.month, row.day, row.hour) == (2, 2, 5)
    row = silver_of(spark, json.dumps({"symbol": "X"}))
    assert (row.symbol, row.price, row.trade_id) == ("UNKNOWN", 0.0, None)


def test_broken_records_are_set_aside(spark):
    bad = ["{", "5", "null", "[]", "", "text", envelope() + " tail", '{"payload": "text"}']
    rows = decoded(spark, envelope(), *bad)
    assert trades.silver(rows).count() == 1
    assert trades.bronze(rows).count() == 1
    letters = trades.rejected(rows, F.lit("0")).collect()
    assert sorted(json.loads(r.original_data)["_raw"] for r in letters) == sorted(bad)
    assert {r.error_msg for r in letters} == {decode.MALFORMED}


def test_null_message_is_malformed(spark):
    assert decoded(spark, None).first().malformed


def test_unreadable_number_is_a_dead_letter_but_kept_in_bronze(spark):
    value = envelope(p="n/a")
    rows = decoded(spark, value)
    assert trades.silver(rows).count() == 0
    assert trades.bronze(rows).first().raw_json == value
    assert trades.rejected(rows, F.lit("0")).first().original_data == value


def test_fixed_schema_keeps_malformed_rows(spark):
    rows = spark.createDataFrame([("{",), ('{"title": "t"}',)], "value string")
    assert decode.fixed_schema(rows, RAW_ARTICLE).count() == 2
    assert decode.valid_only(rows, RAW_ARTICLE).count() == 1
    assert decode.quarantine(rows, RAW_ARTICLE).count() == 1


def test_mistyped_field_is_quarantined(spark):
    rows = spark.createDataFrame([('{"content_length": "x"}',)], "value string")
    assert decode.quarantine(rows, RAW_ARTICLE).count() == 1


def test_envelope_defaults_differ(spark):
    none = F.lit(None).cast("string")
    key, value = trades.wrap_envelope(F.lit('{"t":1}'), none, F.lit(RECEIVED).cast("timestamp"))
    row = spark.range(1).select(key.alias("key"), value.alias("value")).first()
    assert row.key == "UNKNOWN"
    assert json.loads(row.value) == {"source": "binance_ws", "stream": "trade", "symbol": "BTCUSDT",
                                     "received_at": RECEIVED, "payload": {"t": 1}}


def test_backfill(spark):
    full = decode.backfill(spark.createDataFrame([("s",)], "source string"))
    assert set(full.columns) == set(RAW_ARTICLE.fieldNames())
    assert full.schema["content_length"].dataType.typeName() == "integer"


def test_json_text_is_parsed_once(spark):
    rows = decoded(spark, envelope())
    plan = trades.silver(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_last_hour_bound_is_pushed_to_the_scan(spark, folder):
    path = folder("trades")
    trades.silver(decoded(spark, envelope())).write.parquet(path)
    table = spark.read.parquet(path)
    recent = trades.since(table, trades.newest_time(table))
    assert trades.average_price(recent).first().n_trades == 1
    assert "GreaterThanOrEqual(trade_time" in recent._jdf.queryExecution().executedPlan().toString()


def test_latest_price_breaks_ties_by_id(spark):
    rows = spark.createDataFrame([(1, 5, 10.0), (2, 5, 20.0), (3, 4, 30.0)],
                                 "trade_id long, trade_time int, price double")
    assert trades.latest_price(rows).first().latest_price == 20.0
