"""Trade envelopes to bronze and silver, and the statistics asked of trades."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions import times
from newslake.operators.decode import MALFORMED, parse, raw_record
from newslake.schemas import PARTITIONS, TRADE_ENVELOPE
from newslake.sources.lake import part_filter

# Labels and defaults of the trade feed. The key default and the
# envelope default differ on purpose.
FEED_SOURCE = "binance_ws"
FEED_STREAM = "trade"
UNKNOWN_SYMBOL = "UNKNOWN"
ENVELOPE_SYMBOL = "BTCUSDT"

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def wrap_envelope(
    payload_json: Column, symbol: Column, received_at: Column
) -> tuple[Column, Column]:
    """Key and value under which a raw exchange message is published.

    The payload text is spliced in as it is, so its numbers keep their form.
    """
    head = F.to_json(
        F.struct(
            F.lit(FEED_SOURCE).alias("source"),
            F.lit(FEED_STREAM).alias("stream"),
            F.coalesce(symbol, F.lit(ENVELOPE_SYMBOL)).alias("symbol"),
            times.iso(received_at).alias("received_at"),
        )
    )
    value = F.concat(F.regexp_replace(head, r"\}$", ',"payload":'), payload_json, F.lit("}"))
    return F.coalesce(symbol, F.lit(UNKNOWN_SYMBOL)), value


def _number(key: str) -> Column:
    """Payload number: 0 when the key is absent, null when it is no number."""
    payload = F.col("data.payload")
    present = F.coalesce(F.map_contains_key(payload, key), F.lit(False))
    return F.when(present, payload[key].try_cast("double")).otherwise(F.lit(0.0))


def decode_trades(messages: DataFrame) -> DataFrame:
    """Decode envelopes once; both layers and the dead letters derive from it.

    ``error`` is null for a good record and says what is wrong otherwise.
    """
    parsed = parse(messages, TRADE_ENVELOPE)
    unreadable = _number("p").isNull() | _number("q").isNull()
    error = F.when(F.col("malformed"), F.lit(MALFORMED)).when(
        unreadable, F.lit("price or quantity is not a number")
    )
    return parsed.withColumn("error", error)


def bronze(decoded: DataFrame, *keep: str, anchor: Column | None = None) -> DataFrame:
    """Raw layer: every decodable message word for word, by receive time."""
    received = times.parse_time(F.col("data.received_at"))
    parts = times.partition_parts(received, anchor)
    return decoded.where(~F.col("malformed")).select(
        *keep,
        F.col("value").alias("raw_json"),
        F.coalesce("data.symbol", F.lit(UNKNOWN_SYMBOL)).alias("symbol"),
        received.alias("received_at"),
        *[parts[p].alias(p) for p in PARTITIONS],
    )


def silver(decoded: DataFrame, *keep: str, anchor: Column | None = None) -> DataFrame:
    """Typed layer, by trade time. A late trade goes to its own hour."""
    payload = F.col("data.payload")
    trade_time = F.timestamp_millis(payload["T"].try_cast("long"))
    price, quantity = _number("p"), _number("q")
    parts = times.partition_parts(trade_time, anchor)
    return decoded.where(F.col("error").isNull()).select(
        *keep,
        payload["t"].try_cast("long").alias("trade_id"),
        F.coalesce(payload["s"], F.lit(UNKNOWN_SYMBOL)).alias("symbol"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity).alias("amount"),
        F.when(payload["m"] == "true", "SELL").otherwise("BUY").alias("side"),
        trade_time.alias("trade_time"),
        times.parse_time(F.col("data.received_at")).alias("received_at"),
        *[parts[p].alias(p) for p in PARTITIONS],
    )


def rejected(decoded: DataFrame, failed_at: Column, *keep: str) -> DataFrame:
    """Dead letters: the record that failed, why, and when."""
    original = F.when(F.col("malformed"), raw_record(F.col("value"))).otherwise(F.col("value"))
    return decoded.where(F.col("error").isNotNull()).select(
        *keep,
        original.alias("original_data"),
        F.col("error").alias("error_msg"),
        failed_at.alias("failed_at"),
    )


def newest_time(trades: DataFrame, column: str = "trade_time") -> datetime | None:
    """Latest event time in UTC, a one-row aggregate used as "now" for fixed data."""
    micros = trades.agg(F.unix_micros(F.max(column).cast("timestamp")).alias("t")).first()["t"]
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def since(trades: DataFrame, moment, hours: int = 1, column: str = "trade_time") -> DataFrame:
    """Trades of the last hours before ``moment``.

    ``moment`` is a value, not a column, so the bound is a literal that reaches
    the Parquet scan.
    """
    bound = F.lit(moment) - F.make_dt_interval(hours=F.lit(hours))
    return trades.where(F.col(column) >= bound)


def recent(table: DataFrame, newest: tuple[int, ...] | None, hours: int = 1) -> DataFrame:
    """Trades of the last hours of a silver lake table.

    "Now" is the newest trade, looked up in the ``newest`` partition (``lake.newest_hour``); only partitions
    of the last hours are read. If the newest one holds no times, all are asked.
    """
    moment = None if newest is None else newest_time(table.where(part_filter(*newest)))
    moment = moment or newest_time(table)
    if moment is None:
        return table.limit(0)
    held = [moment - timedelta(hours=h) for h in range(hours + 1)]
    in_hours = [part_filter(at.year, at.month, at.day, at.hour) for at in held]
    return since(table.where(reduce(Column.__or__, in_hours)), moment, hours)


def average_price(trades: DataFrame) -> DataFrame:
    return trades.agg(
        F.round(F.avg("price"), 6).alias("avg_price"), F.count("*").alias("n_trades")
    )


def volume(trades: DataFrame, *by: str) -> DataFrame:
    return trades.groupBy(*by).agg(
        F.round(F.sum("quantity"), 6).alias("quantity"),
        F.round(F.sum("amount"), 4).alias("amount"),
        F.count("*").alias("n_trades"),
    )


def trade_order() -> Column:
    """Order of trades by time, then id, nulls first, as one number: an aggregate that keeps a number is hashed, one that keeps a
    struct has to sort the table."""
    wide = "decimal(38,0)"
    time = F.coalesce(F.unix_micros(F.col("trade_time").cast("timestamp")), F.lit(-(10**17))).cast("decimal(18,0)").cast(wide)
    # Ids take the 20 digits below the time; a null one is below all others.
    number = F.coalesce(F.col("trade_id").cast(wide) + F.lit(Decimal(2**63 + 1)), F.lit(0).cast(wide))
    return (time * F.lit(Decimal(10**20)) + number).cast(wide)


def latest_price(trades: DataFrame, *by: str) -> DataFrame:
    """Price of the newest trade; the higher id wins between equal times."""
    return trades.groupBy(*by).agg(
        F.max_by("price", trade_order()).alias("latest_price"),
        F.max("trade_time").alias("trade_time"),
    )


def partition_counts(table: DataFrame) -> DataFrame:
    return table.groupBy(*PARTITIONS).agg(F.count("*").alias("n_rows"))
