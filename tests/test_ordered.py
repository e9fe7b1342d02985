"""Ordered records, transcripts and long answers; approximate distinct; the order of trades as a number."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from newslake.operators import retrieval, sketches, sqltool, trades
from newslake.plans import lakes
from newslake.session import scratch_path
from newslake.sources import ordered

TURNS = "conv_id long, turn long, role string, text string, at timestamp"


def _turns(spark):
    at = datetime(2026, 1, 27, 15, 10, 0, 5)
    rows = [(7, t, "user", f"t{t}\n\"é\"", at + timedelta(hours=t)) for t in range(130)]  # one conversation with most rows
    rows += [(c, t, None if t else "system", None, None) for c in (1, 9, None) for t in range(3)]
    random.Random(1).shuffle(rows)
    return rows, spark.createDataFrame(rows, TURNS).repartition(5)


def test_a_conversation_of_any_length_is_one_transcript(spark):
    rows, turns = _turns(spark)
    path = scratch_path(spark, "t")
    retrieval.write_transcripts(turns, path, rows_per_file=20)
    by_key = {r.conv_id: r.rows for r in ordered.manifest(spark, path).collect()}
    assert by_key == {7: 130, 1: 3, 9: 3, None: 3}
    found = retrieval.read_transcript(spark, path, turns.schema, 7).drop("place").collect()
    assert [tuple(r) for r in found] == sorted(r for r in rows if r[0] == 7)
    assert retrieval.read_transcript(spark, path, turns.schema, 8).count() == 0
    whole = retrieval.transcripts(spark, path, turns.schema).collect()
    assert len(whole) == len(rows)
    assert all(r.position == r.turn + 1 and r.n_turns == by_key[r.conv_id] for r in whole)


def test_slices_open_only_their_files(spark):
    _, turns = _turns(spark)
    path = scratch_path(spark, "t")
    ordered.write_ordered(turns, path, ["turn"], ["conv_id"], rows_per_file=20)
    part = ordered.places(spark, path, turns.schema, 35, 10)
    assert [r.place for r in part.collect()] == list(range(35, 45))
    files = {f.split("file=")[1].split("/")[0] for f in ordered.records(spark, path, turns.schema).inputFiles()}
    assert files == {str(n) for n in range(7)}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "file" in plan.split("PartitionFilters: [")[1].split("]")[0]
    last = ordered.page(spark, path, turns.schema, 13, 10).collect()
    assert [r.place for r in last] == list(range(131, 140))
    assert ordered.page(spark, path, turns.schema, 14, 10).count() == 0


def test_no_rows(spark):
    path = scratch_path(spark, "t")
    retrieval.write_transcripts(spark.createDataFrame([], TURNS), path)
    assert ordered.manifest(spark, path).count() == 0
    assert retrieval.read_transcript(spark, path, spark.createDataFrame([], TURNS).schema, 1).count() == 0


def test_answers_keep_the_order_of_their_statement(spark):
    root = lakes.silver_root(spark, "/root/testdata/sf0.001")
    path = scratch_path(spark, "a")
    sql = "SELECT trade_id FROM trades ORDER BY price DESC, trade_id"
    assert sqltool.answer_to_files(spark, sql, root, path, rows_per_file=100) is None
    wanted = [r["record"] for r in sqltool.query_trades(spark, sql, root).collect()]
    got = sorted((r.place, r.record) for r in sqltool.answer(spark, path).collect())
    assert [r for _, r in got] == wanted and [p for p, _ in got] == list(range(1, len(wanted) + 1))
    assert [r.record for r in sqltool.answer_page(spark, path, 2, 150).collect()] == wanted[300:450]
    assert sqltool.answer_to_files(spark, "DROP TABLE trades", root, path + "x") == sqltool.REJECTED
    assert sqltool.answer_to_files(spark, "SELECT nothing FROM trades", root, path + "y").startswith("Error: ")


def test_trades_are_ordered_by_time_then_id(spark):
    at = datetime(2026, 1, 27)
    rows = [("a", 2**63 - 1, 1.0, at), ("a", -(2**63), 2.0, at), ("a", 5, 3.0, at - timedelta(microseconds=1)), ("a", None, 4.0, at), ("a", 5, 5.0, None),
            ("b", 1, 6.0, datetime(1901, 1, 1)), ("b", 2**62, 7.0, datetime(1900, 1, 1)), ("c", 3, 8.0, datetime(9999, 1, 1)), ("c", 9, None, at)]
    frame = spark.createDataFrame(rows, "symbol string, trade_id long, price double, trade_time timestamp")
    got = {r.symbol: r.latest_price for r in trades.latest_price(frame, "symbol").collect()}
    assert got == {"a": 1.0, "b": 6.0, "c": 8.0}
    order = [r.price for r in frame.where("symbol = 'a'").orderBy(trades.trade_order()).collect()]
    assert order == [5.0, 3.0, 4.0, 2.0, 1.0]
    plan = trades.latest_price(frame, "symbol")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_sketches_of_hours_add_up(spark):
    n = 300_000
    rows = spark.range(n).select((F.col("id") % 100_003).alias("user"), F.lit("k").alias("kind"),
                                 F.timestamp_seconds(F.col("id") % 200_000).alias("at"))
    rows = rows.unionByName(spark.createDataFrame([(None, "k", None), (None, "empty", None)], rows.schema))
    hourly = sketches.hourly_sketches(rows, ["kind"], F.col("at"), "user")
    whole = {r.kind: r.estimate for r in sketches.estimated(sketches.merged(hourly, "kind")).collect()}
    assert abs(whole["k"] - 100_003) < 4 * sketches.relative_error() * 100_003 and whole["empty"] == 0
    twice = sketches.merged(sketches.merged(hourly, "kind", F.date_trunc("day", "hour").alias("day")), "kind")
    assert {r.kind: r.estimate for r in sketches.estimated(twice).collect()} == whole
