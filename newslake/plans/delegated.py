"""What a free SELECT over trades may ask: one query per kind of question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslake.operators import position, sketches, trades
from newslake.plans import lakes
from newslake.plans import stand_ins as si
from newslake.session import settle

_EVENTS = (si.EV, si.SILVER)


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lakes.silver(spark, sf_dir)


def _hour():
    return F.date_trunc("hour", "trade_time").cast("timestamp_ntz").alias("hour_start")


def _day():
    return F.date_trunc("day", "trade_time").cast("timestamp_ntz").alias("day_start")


def d_ohlcv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = trades.trade_order()
    return _trades(spark, sf_dir).groupBy("symbol", _hour()).agg(
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.round(F.sum("quantity"), 6).alias("volume"),
        F.round(F.sum("amount") / F.nullif(F.sum("quantity"), F.lit(0.0)), 6).alias("vwap"),
        F.count("*").alias("n_trades"),
    )


OHLCV_SQL = si.with_ctes(
    """
SELECT symbol, date_trunc('hour', trade_time) AS hour_start,
       arg_min(price, (trade_time, trade_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (trade_time, trade_id)) AS close, round(sum(quantity), 6) AS volume,
       round(sum(amount) / nullif(sum(quantity), 0), 6) AS vwap, count(*) AS n_trades
FROM silver GROUP BY ALL
""",
    *_EVENTS,
)


def d_side_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums in whole millionths, so that a tie in rounding does not hang on the order of addition."""
    units = F.round(F.col("quantity") * 1_000_000).cast("long")
    zero = F.lit(0).cast("long")
    bought = F.sum(F.when(F.col("side") == "BUY", units).otherwise(zero))
    sold = F.sum(F.when(F.col("side") == "SELL", units).otherwise(zero))
    return _trades(spark, sf_dir).groupBy(_hour()).agg(
        (bought / 1_000_000).alias("bought"),
        (sold / 1_000_000).alias("sold"),
        F.round((bought - sold) / F.nullif(bought + sold, zero), 6).alias("imbalance"),
    )


IMBALANCE_SQL = si.with_ctes(
    """
SELECT hour_start, b / 1000000 AS bought, s / 1000000 AS sold,
       round((b - s) / nullif(b + s, 0), 6) AS imbalance
FROM (SELECT date_trunc('hour', trade_time) AS hour_start,
             sum(CASE WHEN side = 'BUY' THEN round(quantity * 1000000)::BIGINT ELSE 0 END)::BIGINT AS b,
             sum(CASE WHEN side = 'SELL' THEN round(quantity * 1000000)::BIGINT ELSE 0 END)::BIGINT AS s
      FROM silver GROUP BY 1)
""",
    *_EVENTS,
)


def d_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("n_users")
    )


DISTINCT_SQL = "SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1"


def d_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per event type and day, and over all days (day null), from hourly sketches; the exact count stands beside and
    ``within_bound`` says whether the estimate is off by at most four standard deviations."""
    e = si.table(spark, sf_dir, "events").select("event_type", "ts", "user_id")
    hourly = settle(sketches.hourly_sketches(e, ["event_type"], F.col("ts"), "user_id"), "sketches")
    day = lambda at: F.date_trunc("day", at).cast("timestamp_ntz").alias("day")
    spans = sketches.merged(hourly, "event_type", day("hour")).withColumn("level", F.lit(0))
    whole = sketches.merged(spans, "event_type").select("event_type", F.lit(None).cast("timestamp_ntz").alias("day"), "sketch", F.lit(1).alias("level"))
    found = sketches.estimated(spans.unionByName(whole))
    exact = e.groupBy("event_type", day("ts")).agg(F.count_distinct("user_id").alias("n_users")).withColumn("level", F.lit(0))
    total = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    exact = exact.unionByName(total.select("event_type", F.lit(None).cast("timestamp_ntz").alias("day"), "n_users", F.lit(1).alias("level")))
    f, x = found.alias("f"), exact.alias("x")
    same = F.col("f.event_type").eqNullSafe(F.col("x.event_type")) & F.col("f.day").eqNullSafe(F.col("x.day")) & (F.col("f.level") == F.col("x.level"))
    bound = F.ceil(F.lit(4 * sketches.relative_error()) * F.col("n_users"))
    return f.join(x, same).select("x.event_type", "x.day", "n_users", (F.abs(F.col("estimate") - F.col("n_users")) <= bound).alias("within_bound"))


APPROX_SQL = """
SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, count(DISTINCT user_id) AS n_users, TRUE AS within_bound
FROM events GROUP BY ALL
UNION ALL
SELECT event_type, NULL, count(DISTINCT user_id), TRUE FROM events GROUP BY event_type
"""


def _grouped(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trades(spark, sf_dir).select("symbol", "side", _day(), "quantity")
    grouped = getattr(t, kind)("symbol", "side", "day_start")
    return grouped.agg(
        F.grouping_id().cast("long").alias("level"),
        F.round(F.sum("quantity"), 6).alias("volume"),
        F.count("*").alias("n_trades"),
    )


def d_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped("rollup", spark, sf_dir)


def d_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped("cube", spark, sf_dir)


def _grouped_sql(kind: str) -> str:
    return si.with_ctes(
        f"""
SELECT symbol, side, day_start, GROUPING(symbol, side, day_start)::BIGINT AS level,
       round(sum(quantity), 6) AS volume, count(*) AS n_trades
FROM (SELECT symbol, side, date_trunc('day', trade_time)::TIMESTAMP AS day_start, quantity
      FROM silver)
GROUP BY {kind} (symbol, side, day_start)
""",
        *_EVENTS,
    )


def d_top_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest three trades per day; at most three per day and task are shuffled."""
    w = Window.partitionBy("day_start").orderBy(F.col("amount").desc(), "trade_id")
    t = _trades(spark, sf_dir).select(_day(), "trade_id", "amount")
    top = t.withColumn("place", F.row_number().over(w)).where("place <= 3")
    return top.withColumn("amount", F.round("amount", 6))


TOP_SQL = si.with_ctes(
    """
SELECT day_start, trade_id, round(amount, 6) AS amount, place::INTEGER AS place
FROM (SELECT date_trunc('day', trade_time)::TIMESTAMP AS day_start, trade_id, amount,
             row_number() OVER (PARTITION BY date_trunc('day', trade_time)
                                ORDER BY amount DESC, trade_id) AS place FROM silver)
WHERE place <= 3
""",
    *_EVENTS,
)


def d_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the last 20 trades of the symbol, which is all of the table."""
    t = _trades(spark, sf_dir).select("symbol", "trade_time", "trade_id", "price")
    mean = {"mean_20": lambda w: F.avg("price").over(w.rowsBetween(-19, 0))}
    rows = position.row_frames(t, ["symbol"], ["trade_time", "trade_id"], 19, mean)
    return rows.select("trade_id", F.round("mean_20", 6).alias("mean_20"))


MOVING_SQL = si.with_ctes(
    """
SELECT trade_id, round(avg(price) OVER (PARTITION BY symbol ORDER BY trade_time, trade_id
                                        ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS mean_20
FROM silver
""",
    *_EVENTS,
)


def d_price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trades(spark, sf_dir).select("symbol", "trade_time", "trade_id", "price")
    last = {"last_price": lambda w: F.lag("price").over(w)}
    rows = position.row_frames(t, ["symbol"], ["trade_time", "trade_id"], 1, last)
    change = F.coalesce(F.col("price") - F.col("last_price"), F.lit(0.0))
    return rows.select("trade_id", F.round(change, 6).alias("price_change"))


CHANGE_SQL = si.with_ctes(
    """
SELECT trade_id, round(coalesce(price - lag(price) OVER (PARTITION BY symbol
                                                         ORDER BY trade_time, trade_id), 0), 6)
         AS price_change
FROM silver
""",
    *_EVENTS,
)


def d_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trades(spark, sf_dir)
    return position.percentiles(t, ["side"], "price", [0.5, 0.95])


PERCENTILE_SQL = si.with_ctes(
    """
SELECT side, 0.5::DOUBLE AS point, round(quantile_cont(price, 0.5), 6) AS percentile
FROM silver GROUP BY side
UNION ALL
SELECT side, 0.95::DOUBLE AS point, round(quantile_cont(price, 0.95), 6) AS percentile
FROM silver GROUP BY side
""",
    *_EVENTS,
)


def d_equi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traded amount per market segment. Each side is summed per key before its
    join, so a key with very many trades joins as one row."""
    per_order = si.large_trades(spark, sf_dir).groupBy("order_id").agg(
        F.sum("amount").alias("amount"), F.count("*").alias("n_trades")
    )
    orders = si.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("c_custkey")
    )
    per_customer = per_order.join(orders, "order_id").groupBy("c_custkey").agg(
        F.sum("amount").alias("amount"), F.sum("n_trades").alias("n_trades")
    )
    customers = si.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return per_customer.join(customers, "c_custkey").groupBy("c_mktsegment").agg(
        F.round(F.sum("amount"), 2).alias("amount"), F.sum("n_trades").alias("n_trades")
    )


EQUI_SQL = si.with_ctes(
    """
SELECT c_mktsegment, round(sum(amount), 2) AS amount, count(*) AS n_trades
FROM large JOIN orders ON o_orderkey = order_id JOIN customer ON c_custkey = o_custkey
GROUP BY 1
""",
    si.LARGE,
)


def d_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = si.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey")
    ).distinct()
    customers = si.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    active = customers.join(buyers, "c_custkey", "left_semi").withColumn("has_orders", F.lit(True))
    idle = customers.join(buyers, "c_custkey", "left_anti").withColumn("has_orders", F.lit(False))
    return active.unionByName(idle).groupBy("c_mktsegment", "has_orders").agg(
        F.count("*").alias("n_customers")
    )


SEMI_ANTI_SQL = """
SELECT c_mktsegment, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders,
       count(*) AS n_customers
FROM customer GROUP BY ALL
"""


def d_gap_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades per calendar hour; hours without any count 0. The calendar is a range
    over the hours between the first and the last trade; no trades, no hours."""
    t = _trades(spark, sf_dir)
    hour = F.floor(F.unix_seconds("trade_time") / 3600)
    span = t.agg(F.min(hour).alias("lo"), F.max(hour).alias("hi")).first()
    bounds = (0, 0) if span["lo"] is None else (span["lo"], span["hi"] + 1)
    calendar = spark.range(*bounds).withColumnRenamed("id", "h")
    counts = t.groupBy(hour.alias("h")).agg(F.count("*").alias("n"))
    at = F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz")
    return calendar.join(counts, "h", "left").select(
        at.alias("hour_start"), F.coalesce("n", F.lit(0)).cast("long").alias("n_trades")
    )


GAP_SQL = si.with_ctes(
    """
SELECT hour_start, count(trade_id) AS n_trades
FROM (SELECT unnest(generate_series((SELECT date_trunc('hour', min(trade_time)) FROM silver),
                                    (SELECT date_trunc('hour', max(trade_time)) FROM silver),
                                    INTERVAL 1 HOUR)) AS hour_start)
LEFT JOIN silver ON date_trunc('hour', trade_time) = hour_start
GROUP BY 1
""",
    *_EVENTS,
)


def d_set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with both finished and open orders, and the orders by which the
    finished ones of a customer outnumber the open ones."""
    o = si.table(spark, sf_dir, "orders")
    done = o.where("o_orderstatus = 'F'").select("o_custkey")
    open_ = o.where("o_orderstatus = 'O'").select("o_custkey")
    both = done.distinct().intersect(open_.distinct()).withColumn("part", F.lit("both"))
    more = done.exceptAll(open_).withColumn("part", F.lit("more finished"))
    never = done.distinct().subtract(open_.distinct()).withColumn("part", F.lit("never open"))
    return both.unionByName(more).unionByName(never)


SET_SQL = """
WITH done AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'),
     still AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT o_custkey, 'both' AS part FROM (SELECT * FROM done INTERSECT SELECT * FROM still)
UNION ALL
SELECT o_custkey, 'more finished' AS part
FROM (SELECT * FROM done EXCEPT ALL SELECT * FROM still)
UNION ALL
SELECT o_custkey, 'never open' AS part FROM (SELECT * FROM done EXCEPT SELECT * FROM still)
"""


def d_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades above the mean price of their day. The means are one row per
    calendar day and settled, so the planner knows they are small and leaves the
    trades where they are."""
    t = _trades(spark, sf_dir).select("trade_id", "price", _day())
    means = settle(t.groupBy("day_start").agg(F.avg("price").alias("mean")), "daily-means")
    above = t.join(means, "day_start").where(F.col("price") > F.col("mean") + 1e-9)
    return above.select("trade_id", "price", "day_start")


SUBQUERY_SQL = si.with_ctes(
    """
SELECT trade_id, price, date_trunc('day', trade_time)::TIMESTAMP AS day_start
FROM silver AS t
WHERE price > (SELECT avg(price) FROM silver AS d
               WHERE date_trunc('day', d.trade_time) = date_trunc('day', t.trade_time)) + 1e-9
""",
    *_EVENTS,
)


def d_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = si.without_zone(_trades(spark, sf_dir).select("trade_id", "price", "trade_time"))
    return t.orderBy(F.col("trade_time").desc(), F.col("trade_id").desc()).limit(10)


LAST_SQL = si.with_ctes(
    """
SELECT trade_id, price, trade_time FROM silver
ORDER BY trade_time DESC, trade_id DESC LIMIT 10
""",
    *_EVENTS,
)

QUERIES = {
    "d_ohlcv_hourly": (d_ohlcv_hourly, OHLCV_SQL),
    "d_side_imbalance": (d_side_imbalance, IMBALANCE_SQL),
    "d_distinct": (d_distinct, DISTINCT_SQL),
    "d_approx_distinct": (d_approx_distinct, APPROX_SQL),
    "d_rollup": (d_rollup, _grouped_sql("ROLLUP")),
    "d_cube": (d_cube, _grouped_sql("CUBE")),
    "d_top_trades": (d_top_trades, TOP_SQL),
    "d_moving_avg": (d_moving_avg, MOVING_SQL),
    "d_price_change": (d_price_change, CHANGE_SQL),
    "d_percentiles": (d_percentiles, PERCENTILE_SQL),
    "d_equi_join": (d_equi_join, EQUI_SQL),
    "d_semi_anti": (d_semi_anti, SEMI_ANTI_SQL),
    "d_gap_hours": (d_gap_hours, GAP_SQL),
    "d_set_ops": (d_set_ops, SET_SQL),
    "d_subquery": (d_subquery, SUBQUERY_SQL),
    "d_last_n": (d_last_n, LAST_SQL),
}
