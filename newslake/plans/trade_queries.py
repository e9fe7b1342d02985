"""Trade feed: decoding, layers, partitions and the statistics asked of trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions import times
from newslake.operators import decode, trades
from newslake.plans import lakes
from newslake.plans import stand_ins as si
from newslake.schemas import BRONZE_TRADE, PARTITIONS, TRADE_ENVELOPE
from newslake.sources import lake

_EVENTS = (si.EV, si.SILVER)
_MESSAGES = (si.EV, si.ENVELOPE)
_IRREGULAR = (si.EV, si.ENVELOPE, si.IRREGULAR)
_PARTS = ", ".join(PARTITIONS)
# Which irregular messages decode: damaged below k = 50, readable above.
_BROKEN = "(event_type = 'error' AND k < 50)"


def silver_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = trades.decode_trades(si.irregular_messages(spark, sf_dir))
    rows = trades.silver(decoded, "event_id", anchor=si.anchor())
    numbered = rows.withColumn("trade_id", F.coalesce("trade_id", F.lit(-1)))
    return si.without_zone(numbered).withColumn("amount", F.round("amount", 6))


SILVER_SQL = si.with_ctes(
    f"""
SELECT event_id, CASE WHEN has_payload THEN event_id ELSE -1 END AS trade_id,
       CASE WHEN has_payload THEN 'BTCUSDT' ELSE 'UNKNOWN' END AS symbol,
       CASE WHEN has_payload THEN value ELSE 0.0::DOUBLE END AS price,
       CASE WHEN has_payload THEN k / 1000.0::DOUBLE ELSE 0.0::DOUBLE END AS quantity,
       CASE WHEN has_payload THEN round(value * (k / 1000.0::DOUBLE), 6) ELSE 0.0::DOUBLE END
         AS amount,
       CASE WHEN has_payload AND event_type IN ('click', 'error') THEN 'SELL' ELSE 'BUY' END
         AS side,
       moment AS trade_time, ts AS received_at, {si.parts_of(f"coalesce(moment, TIMESTAMP '{si.ANCHOR}')")}
FROM (SELECT *, CASE WHEN event_type NOT IN ('error', 'signup') THEN make_timestamp(ms * 1000)
                END AS moment,
             event_type <> 'error' AS has_payload
      FROM ev WHERE event_type <> 'error' OR k >= 75)
""",
    si.EV,
)


def bronze_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = trades.decode_trades(si.irregular_messages(spark, sf_dir))
    return si.without_zone(trades.bronze(decoded, "event_id", anchor=si.anchor()))


BRONZE_SQL = si.with_ctes(
    f"""
SELECT event_id, value AS raw_json, 'BTCUSDT' AS symbol, ts AS received_at, {si.parts_of("ts")}
FROM irregular WHERE NOT {_BROKEN}
""",
    *_IRREGULAR,
)


def json_decode_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.valid_only(si.irregular_messages(spark, sf_dir), TRADE_ENVELOPE, "event_id")
    payload = F.col("payload")
    return rows.select(
        "event_id", "source", "stream", "symbol", "received_at",
        payload["p"].alias("p"), payload["T"].alias("big_t"), payload["t"].alias("small_t"),
    )


DECODE_COLUMNS = """
       'binance_ws' AS source, 'trade' AS stream, 'BTCUSDT' AS symbol,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS received_at"""
DECODE_VALID_SQL = si.with_ctes(
    f"""
SELECT event_id, {DECODE_COLUMNS},
       json_extract_string(value, '$.payload.p') AS p,
       json_extract_string(value, '$.payload.T') AS big_t,
       json_extract_string(value, '$.payload.t') AS small_t
FROM irregular WHERE NOT {_BROKEN}
""",
    *_IRREGULAR,
)


def json_decode_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.fixed_schema(si.irregular_messages(spark, sf_dir), TRADE_ENVELOPE, "event_id")
    return rows.select("event_id", "source", "stream", "symbol", "received_at")


DECODE_SCHEMA_SQL = si.with_ctes(
    f"""
SELECT event_id, CASE WHEN {_BROKEN} THEN NULL ELSE source END AS source,
       CASE WHEN {_BROKEN} THEN NULL ELSE stream END AS stream,
       CASE WHEN {_BROKEN} THEN NULL ELSE symbol END AS symbol,
       CASE WHEN {_BROKEN} THEN NULL ELSE received_at END AS received_at
FROM (SELECT event_id, event_type, k, {DECODE_COLUMNS} FROM irregular)
""",
    *_IRREGULAR,
)


def json_decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.quarantine(si.irregular_messages(spark, sf_dir), TRADE_ENVELOPE, "event_id")


QUARANTINE_SQL = si.with_ctes(
    f"""
SELECT event_id, to_json({{'_raw': value}})::VARCHAR AS original_data,
       'malformed JSON' AS error_msg
FROM irregular WHERE {_BROKEN}
""",
    *_IRREGULAR,
)


def dead_letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = trades.decode_trades(si.irregular_messages(spark, sf_dir))
    return trades.rejected(decoded, F.unix_seconds(si.anchor()).cast("string"), "event_id")


DEAD_LETTER_SQL = si.with_ctes(
    f"""
SELECT event_id,
       CASE WHEN {_BROKEN} THEN to_json({{'_raw': value}})::VARCHAR ELSE value END AS original_data,
       CASE WHEN {_BROKEN} THEN 'malformed JSON'
            ELSE 'price or quantity is not a number' END AS error_msg,
       epoch(TIMESTAMP '{si.ANCHOR}')::BIGINT::VARCHAR AS failed_at
FROM irregular WHERE event_type = 'error' AND k < 75
""",
    *_IRREGULAR,
)


def wrap_trade_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols are missing from the ``signup`` messages, where the defaults differ."""
    m = si.trade_messages(spark, sf_dir)
    payload = F.regexp_extract("value", '"payload":(.*)\\}$', 1)
    symbol = F.when(F.col("event_type") != "signup", "BTCUSDT")
    key, value = trades.wrap_envelope(payload, symbol, F.col("at"))
    return m.select("event_id", key.alias("key"), value.alias("value"))


WRAP_SQL = si.with_ctes(
    """
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'UNKNOWN' ELSE 'BTCUSDT' END AS key, value
FROM envelope
""",
    *_MESSAGES,
)


def trades_view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    lake.trades_view(spark, lakes.silver_root(spark, sf_dir))
    return spark.sql(
        "SELECT trade_id, symbol, price, quantity, side,"
        " CAST(trade_time AS TIMESTAMP_NTZ) AS trade_time, year, month, day, hour FROM trades"
    )


VIEW_SQL = si.with_ctes(
    f"""
SELECT trade_id, symbol, price, quantity, side, trade_time, {si.parts_of("trade_time")}
FROM silver
""",
    *_EVENTS,
)


def silver_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lakes.silver(spark, sf_dir)
    return si.without_zone(rows).withColumn("amount", F.round("amount", 6))


SILVER_ROUND_SQL = si.with_ctes(
    f"""
SELECT trade_id, symbol, price, quantity, round(amount, 6) AS amount, side, trade_time,
       received_at, {si.parts_of("trade_time")}
FROM silver
""",
    *_EVENTS,
)


def bronze_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    rows = lake.scan(spark, lakes.bronze_root(spark, sf_dir), BRONZE_TRADE)
    return si.without_zone(rows)


BRONZE_ROUND_SQL = si.with_ctes(
    f"""
SELECT value AS raw_json, 'BTCUSDT' AS symbol, ts AS received_at, {si.parts_of("ts")}
FROM envelope
""",
    *_MESSAGES,
)


def partition_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.partition_counts(lakes.silver(spark, sf_dir))


COUNTS_SQL = si.with_ctes(
    f"""
SELECT {_PARTS}, count(*) AS n_rows
FROM (SELECT {si.parts_of("trade_time")} FROM silver) GROUP BY {_PARTS}
""",
    *_EVENTS,
)


def late_rows_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades received up to three days late: each is in the hour it was made."""
    decoded = trades.decode_trades(si.trade_messages(spark, sf_dir))
    late = F.make_dt_interval(hours=F.col("k").cast("int"))
    received = times.iso(F.col("at") + late)
    moved = decoded.withColumn("data", F.col("data").withField("received_at", received))
    rows = trades.silver(moved, "k", anchor=si.anchor())
    delay = F.unix_seconds("received_at") - F.unix_seconds("trade_time")
    return rows.groupBy(*PARTITIONS).agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(delay >= 3600, 1)).alias("n_late"),
        F.max(F.floor(delay / 3600)).cast("long").alias("max_hours_late"),
    )


LATE_SQL = si.with_ctes(
    f"""
SELECT {_PARTS}, count(*) AS n_rows, count(CASE WHEN k >= 1 THEN 1 END) AS n_late,
       max(k)::BIGINT AS max_hours_late
FROM (SELECT k, {si.parts_of("trade_time")} FROM silver) GROUP BY {_PARTS}
""",
    *_EVENTS,
)


def recent_avg_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price of the last hour of data."""
    t = lakes.silver(spark, sf_dir)
    return trades.average_price(trades.recent(t, lakes.newest_trade_hour(spark, sf_dir)))


RECENT_SQL = si.with_ctes(
    """
SELECT round(avg(price), 6) AS avg_price, count(*) AS n_trades FROM silver
WHERE trade_time >= (SELECT max(trade_time) FROM silver) - INTERVAL 1 HOUR
""",
    *_EVENTS,
)


def trade_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.volume(si.large_trades(spark, sf_dir), "side")


VOLUME_SQL = si.with_ctes(
    """
SELECT side, round(sum(quantity), 6) AS quantity, round(sum(amount), 4) AS amount,
       count(*) AS n_trades
FROM large GROUP BY side
""",
    si.LARGE,
)


def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.without_zone(trades.latest_price(lakes.silver(spark, sf_dir), "symbol", "side"))


LATEST_SQL = si.with_ctes(
    """
SELECT symbol, side, price AS latest_price, trade_time
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, side
                                   ORDER BY trade_time DESC, trade_id DESC) AS rn FROM silver)
WHERE rn = 1
""",
    *_EVENTS,
)


def interval_to_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start of the ten-minute interval before each event to its hour partition;
    the ``error`` events have no interval and fall back to the anchor."""
    e = si.table(spark, sf_dir, "events")
    ten = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 600) * 600)
    start = F.when(F.col("event_type") != "error", ten - F.expr("INTERVAL 10 MINUTES"))
    parts = times.partition_parts(start, si.anchor())
    return e.select("event_id", *[parts[p].alias(p) for p in PARTITIONS])


INTERVAL_SQL = f"""
SELECT event_id, {si.parts_of("moment")}
FROM (SELECT event_id,
             CASE WHEN event_type = 'error' THEN TIMESTAMP '{si.ANCHOR}'
                  ELSE time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 10 MINUTE END AS moment
      FROM events)
"""


def clock_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``HH:MM`` of every event against the anchor; ``error`` events have a bad
    clock text."""
    e = si.table(spark, sf_dir, "events")
    clock = F.when(F.col("event_type") == "error", "25:99").otherwise(F.date_format("ts", "HH:mm"))
    at = times.clock_to_time(clock, si.anchor())
    return e.select("event_id", clock.alias("clock"), at.cast("timestamp_ntz").alias("at"))


CLOCK_SQL = f"""
SELECT event_id, clock,
       CASE WHEN clock = '25:99' THEN NULL
            WHEN clock > '12:34' THEN TIMESTAMP '2024-02-29' + since
            ELSE TIMESTAMP '2024-03-01' + since END AS at
FROM (SELECT event_id, date_trunc('minute', ts) - date_trunc('day', ts) AS since,
             CASE WHEN event_type = 'error' THEN '25:99' ELSE strftime(ts, '%H:%M') END AS clock
      FROM events)
"""


def korean_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Korean date text of every event. ``error``: no date; ``signup``: a day that
    does not exist; ``view``: a bad clock."""
    e = si.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    written = F.concat(
        F.year("ts").cast("string"), F.lit("년 "), F.month("ts").cast("string"), F.lit("월 "),
        F.when(kind == "signup", "99").otherwise(F.dayofmonth("ts").cast("string")),
        F.lit("일 화요일"),
    )
    date_text = F.when(kind == "error", "날짜 정보 없음").otherwise(written)
    clock = F.when(kind == "view", "soon").otherwise(F.date_format("ts", "HH:mm"))
    at = times.dated_clock_to_time(date_text, clock, si.anchor())
    return e.select("event_id", date_text.alias("date_text"), at.cast("timestamp_ntz").alias("at"))


KOREAN_SQL = f"""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN '날짜 정보 없음'
            ELSE date_part('year', ts) || '년 ' || date_part('month', ts) || '월 '
                 || CASE WHEN event_type = 'signup' THEN '99'
                         ELSE date_part('day', ts)::VARCHAR END || '일 화요일' END AS date_text,
       CASE WHEN event_type = 'view' THEN TIMESTAMP '{si.ANCHOR}'
            WHEN event_type IN ('error', 'signup')
              THEN TIMESTAMP '2024-03-01' + (date_trunc('minute', ts) - date_trunc('day', ts))
            ELSE date_trunc('minute', ts) END AS at
FROM events
"""

QUERIES = {
    "silver_trades": (silver_trades, SILVER_SQL),
    "bronze_trades": (bronze_trades, BRONZE_SQL),
    "json_decode_valid": (json_decode_valid, DECODE_VALID_SQL),
    "json_decode_schema": (json_decode_schema, DECODE_SCHEMA_SQL),
    "json_decode_quarantine": (json_decode_quarantine, QUARANTINE_SQL),
    "dead_letter_rows": (dead_letter_rows, DEAD_LETTER_SQL),
    "wrap_trade_envelope": (wrap_trade_envelope, WRAP_SQL),
    "trades_view_scan": (trades_view_scan, VIEW_SQL),
    "silver_partition_roundtrip": (silver_partition_roundtrip, SILVER_ROUND_SQL),
    "bronze_partition_roundtrip": (bronze_partition_roundtrip, BRONZE_ROUND_SQL),
    "partition_row_counts": (partition_row_counts, COUNTS_SQL),
    "late_rows_partitioned": (late_rows_partitioned, LATE_SQL),
    "recent_avg_price": (recent_avg_price, RECENT_SQL),
    "trade_volume": (trade_volume, VOLUME_SQL),
    "latest_price": (latest_price, LATEST_SQL),
    "interval_to_partition": (interval_to_partition, INTERVAL_SQL),
    "clock_to_timestamp": (clock_to_timestamp, CLOCK_SQL),
    "korean_date_parse": (korean_date_parse, KOREAN_SQL),
}
