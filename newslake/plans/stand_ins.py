"""The given tables in the shape of the feeds, for Spark and as SQL.

``events`` plays the trade topic, ``documents`` the article feeds, ``lineitem`` a
large trade table, ``pages`` the crawled pages, ``benchmark`` the questions. The
stand-ins add the irregular records that the operators must handle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions import times
from newslake.functions.text import BOILERPLATE, WHITESPACE
from newslake.operators.trades import wrap_envelope
from newslake.session import spread, use_utc

# "Now" for all queries, so that results do not depend on the day they run.
ANCHOR = "2024-03-01 12:34:00"
START_SECONDS = 1704067200  # 2024-01-01


def anchor() -> Column:
    return F.lit(ANCHOR).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_zone(df: DataFrame) -> DataFrame:
    """UTC times as zone-less ones, the form the tables use."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _fixed(number: Column) -> Column:
    return F.format_string("%.8f", number)


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, key, value``: one envelope per event."""
    e = spread(table(spark, sf_dir, "events"), "event_id").withColumns(
        {
            "at": F.col("ts").cast("timestamp"),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )
    ms = F.unix_millis("at")
    maker = F.when(F.col("event_type").isin("click", "error"), "true").otherwise("false")
    payload = F.concat(
        F.lit('{"e":"trade","E":'), (ms + 1).cast("string"),
        F.lit(',"s":"BTCUSDT","t":'), F.col("event_id").cast("string"),
        F.lit(',"p":"'), _fixed(F.col("value")),
        F.lit('","q":"'), _fixed(F.col("k") / 1000),
        F.lit('","T":'), ms.cast("string"),
        F.lit(',"m":'), maker, F.lit(',"M":true}'),
    )
    key, value = wrap_envelope(payload, F.lit("BTCUSDT"), F.col("at"))
    return e.select("event_id", key.alias("key"), value.alias("value"), "event_type", "k", "at")


def irregular_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade messages of which the ``error`` events are damaged in four ways and
    the ``signup`` events have no trade time."""
    m = trade_messages(spark, sf_dir)
    k, value = F.col("k"), F.col("value")
    damaged = (
        F.when(k < 25, F.substring(value, 1, 60))
        .when(k < 50, F.lit("5"))
        .when(k < 75, F.regexp_replace(value, '"p":"[^"]*"', '"p":"n/a"'))
        .otherwise(F.concat(F.regexp_replace(value, ',"payload":.*$', ""), F.lit("}")))
    )
    no_time = F.regexp_replace(value, ',"T":[0-9]+', "")
    kind = F.col("event_type")
    return m.withColumn(
        "value", F.when(kind == "error", damaged).when(kind == "signup", no_time).otherwise(value)
    )


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` for work that is heavy per text."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and the raw article columns."""
    return _articles_from(table(spark, sf_dir, "documents"))


def spread_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_articles`` for work that is heavy per text."""
    return _articles_from(spread_documents(spark, sf_dir))


def _articles_from(d: DataFrame) -> DataFrame:
    n, s, body = F.col("doc_id") % 10, F.col("doc_id") % 3, F.col("text")
    at = F.timestamp_seconds(F.lit(START_SECONDS) + F.col("doc_id") * 60)
    content = (
        F.when(n == 0, F.concat(F.lit("홍길동 reporter@example.com "), body))
        .when(n == 1, F.concat(body, F.lit(" <저작권자 ⓒ 뉴스, 무단전재 금지>")))
        .when(n == 2, F.concat(F.lit("(서울=뉴스) 홍길동 기자 = "), body))
        .when(n == 3, F.concat(F.lit("[서울 홍길동 기자] "), body))
        .when(n == 4, F.concat(F.lit("　\n"), body, F.lit(" \t")))
        .when(n == 7, F.lit(""))
        .otherwise(body)
    )
    link = F.concat(F.lit("https://news.example/"), F.md5(body))
    return d.select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(n != 8, link).alias("link"),
        F.when(n == 6, "not a date").otherwise(times.iso(at)).alias("published_at"),
        content.alias("content"),
        F.length(content).alias("content_length"),
        times.iso(at + F.expr("INTERVAL 90 SECONDS")).alias("crawled_at"),
        F.when(s == 0, "coindesk").otherwise("coinness").alias("source"),
        F.when(s == 0, F.lit(None)).when(n == 5, "").when(s == 1, "breaking")
        .otherwise("newsroom").alias("news_type"),
    )


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs already in the vector table: those of the labelled documents."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    articles = raw_articles(spark, sf_dir).select("doc_id", F.col("link").alias("url"))
    return articles.join(labelled, "doc_id", "left_semi").select("url")


def large_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trades of day grain; it has no unique id."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_linestatus") == "F", "SELL").otherwise("BUY").alias("side"),
        F.col("l_shipdate").alias("trade_time"),
    )


# --- the same as SQL ----------------------------------------------------------

SQL_WHITESPACE = "'" + WHITESPACE + "'"
SQL_BOILERPLATE = "'" + "|".join(BOILERPLATE) + "'"

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS ms
  FROM events)"""

SILVER = """
silver AS (
  SELECT event_id AS trade_id, 'BTCUSDT' AS symbol, value AS price,
         k / 1000.0::DOUBLE AS quantity, value * (k / 1000.0::DOUBLE) AS amount,
         CASE WHEN event_type IN ('click', 'error') THEN 'SELL' ELSE 'BUY' END AS side,
         make_timestamp(ms * 1000) AS trade_time, ts AS received_at,
         user_id, event_type, k
  FROM ev)"""

ENVELOPE = """
envelope AS (
  SELECT event_id, ts, ms, event_type, k,
         '{"source":"binance_ws","stream":"trade","symbol":"BTCUSDT","received_at":"'
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","payload":{"e":"trade","E":'
         || (ms + 1) || ',"s":"BTCUSDT","t":' || event_id || ',"p":"' || printf('%.8f', value)
         || '","q":"' || printf('%.8f', k / 1000.0::DOUBLE) || '","T":' || ms || ',"m":'
         || CASE WHEN event_type IN ('click', 'error') THEN 'true' ELSE 'false' END
         || ',"M":true}}' AS value
  FROM ev)"""

IRREGULAR = """
irregular AS (
  SELECT event_id, ts, ms, event_type, k,
         CASE WHEN event_type = 'error' AND k < 25 THEN substr(value, 1, 60)
              WHEN event_type = 'error' AND k < 50 THEN '5'
              WHEN event_type = 'error' AND k < 75
                THEN regexp_replace(value, '"p":"[^"]*"', '"p":"n/a"')
              WHEN event_type = 'error' THEN split_part(value, ',"payload":', 1) || '}'
              WHEN event_type = 'signup' THEN regexp_replace(value, ',"T":[0-9]+', '')
              ELSE value END AS value
  FROM envelope)"""

DOC = """
doc AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS title,
         CASE WHEN doc_id % 10 <> 8 THEN 'https://news.example/' || md5(text) END AS link,
         CASE WHEN doc_id % 10 <> 6
              THEN TIMESTAMP '2024-01-01' + to_minutes(doc_id::INTEGER) END AS published_ts,
         CASE WHEN doc_id % 10 = 6 THEN 'not a date'
              ELSE strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id::INTEGER),
                            '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS published_at,
         CASE doc_id % 10
              WHEN 0 THEN '홍길동 reporter@example.com ' || text
              WHEN 1 THEN text || ' <저작권자 ⓒ 뉴스, 무단전재 금지>'
              WHEN 2 THEN '(서울=뉴스) 홍길동 기자 = ' || text
              WHEN 3 THEN '[서울 홍길동 기자] ' || text
              WHEN 4 THEN '　' || chr(10) || text || ' ' || chr(9)
              WHEN 7 THEN '' ELSE text END AS content,
         TIMESTAMP '2024-01-01' + to_minutes(doc_id::INTEGER) + INTERVAL 90 SECOND AS crawled_ts,
         CASE WHEN doc_id % 3 = 0 THEN 'coindesk' ELSE 'coinness' END AS source,
         CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 10 = 5 THEN ''
              WHEN doc_id % 3 = 1 THEN 'breaking' ELSE 'newsroom' END AS news_type
  FROM documents)"""

REFINED = f"""
refined AS (
  SELECT doc_id, title, link, published_ts AS published_at,
         trim(CASE WHEN source LIKE 'coinness%'
                   THEN regexp_replace(content, {SQL_BOILERPLATE}, '', 'g')
                   ELSE content END, {SQL_WHITESPACE}) AS content,
         length(content)::INTEGER AS content_length, crawled_ts AS crawled_at,
         CASE WHEN news_type IS NULL OR news_type = '' THEN source
              ELSE source || '-' || news_type END AS source,
         date_part('minute', moment)::INTEGER AS min, date_part('year', moment)::INTEGER AS year,
         date_part('month', moment)::INTEGER AS month, date_part('day', moment)::INTEGER AS day,
         date_part('hour', moment)::INTEGER AS hour
  FROM (SELECT *, coalesce(published_ts, TIMESTAMP '{ANCHOR}') AS moment FROM doc))"""

LARGE = """
large AS (
  SELECT l_orderkey AS order_id, l_extendedprice / l_quantity AS price, l_quantity AS quantity,
         l_extendedprice AS amount,
         CASE WHEN l_linestatus = 'F' THEN 'SELL' ELSE 'BUY' END AS side,
         l_shipdate AS trade_time
  FROM lineitem)"""

STORED = """
stored AS (
  SELECT DISTINCT link AS url FROM doc
  WHERE link IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels))"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def parts_of(expression: str) -> str:
    """Partition columns of a time expression as SQL."""
    return ", ".join(
        f"date_part('{p}', {expression})::INTEGER AS {p}" for p in ("year", "month", "day", "hour")
    )
