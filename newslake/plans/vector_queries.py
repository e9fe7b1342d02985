"""Embedding, the vector table, retrieval, and SQL over trades."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions import text
from newslake.operators import chunk, dedup, embed, metrics, news, retrieval, search, search_sql, sqltool
from newslake.operators import trades as trade_ops
from newslake.operators import vectors
from newslake.plans import lakes
from newslake.plans import stand_ins as si
from newslake.session import scratch_path
from newslake.streaming import ingest as ingest_job

DIMENSION = lakes.DIMENSION
REFUSED = "ß"

# --- SQL counterparts of the article table and of its vectors ------------------

_ARTICLE_CTES = (
    si.DOC,
    si.REFINED,
    """
identified AS (
  SELECT *, md5(coalesce(link, content)) AS id, coalesce(link, '') AS url
  FROM refined WHERE content <> ''),
article AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn
                 FROM identified) WHERE rn = 1)""",
)


def _vectors_cte(name: str, source: str, key: str, column: str) -> str:
    """Sparse vectors of a text column: one row per key and slot."""
    return f"""
{name}_word AS (
  SELECT {key} AS key, md5(word) AS h
  FROM (SELECT {key}, unnest(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+')) AS word
        FROM {source}) WHERE word <> ''),
{name}_count AS (
  SELECT key, ('0x' || substr(h, 1, 8))::BIGINT % {DIMENSION} AS slot,
         sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS w
  FROM {name}_word GROUP BY 1, 2),
{name} AS (
  SELECT key, slot, (w / sqrt(sum(w * w) OVER (PARTITION BY key)))::FLOAT::DOUBLE AS x
  FROM {name}_count WHERE w <> 0)"""


_SEARCH_CTES = (
    *_ARTICLE_CTES,
    _vectors_cte("av", "article", "id", "content"),
    _vectors_cte("qv", "benchmark", "item_id", "text"),
    """
an AS (SELECT key, sqrt(sum(x * x)) AS size FROM av GROUP BY key),
qn AS (SELECT key, sqrt(sum(x * x)) AS size FROM qv GROUP BY key),
dots AS (
  SELECT qv.key AS question_id, av.key AS id, sum(qv.x * av.x) AS d
  FROM qv JOIN av USING (slot) GROUP BY ALL),
scored AS (
  SELECT question_id, id, round(d / (qn.size * an.size), 9) AS score
  FROM dots JOIN qn ON qn.key = question_id JOIN an ON an.key = id),
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id)
                           ::INTEGER AS rank FROM scored) WHERE rank <= 5)""",
)


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = si.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")
    return embed.with_vectors(asked, embed.HashedWords(DIMENSION), "text")


def embed_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-zero components of each document's vector."""
    d = si.spread_documents(spark, sf_dir)
    rows = embed.with_vectors(d, embed.HashedWords(DIMENSION), "text")
    parts = rows.select("doc_id", F.posexplode("vector").alias("slot", "x")).where("x <> 0")
    return parts.select("doc_id", "slot", F.round(F.col("x").cast("double"), 6).alias("x"))


EMBED_SQL = si.with_ctes(
    "SELECT key AS doc_id, slot::INTEGER AS slot, round(x, 6) AS x FROM dv",
    _vectors_cte("dv", "documents", "doc_id", "text"),
)


class Refusing(embed.HashedWords):
    """An embedder that fails for texts holding a certain letter, as a service
    fails for some of its input."""

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if any(REFUSED in (t or "") for t in texts.to_pylist()):
            raise ValueError("refused")
        return super().__call__(texts)


_NO_WAIT = (0, 0, 0)


def embed_retry_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.spread_documents(spark, sf_dir)
    rows = embed.with_vectors(d, Refusing(DIMENSION), "text", _NO_WAIT)
    return rows.select(
        "doc_id",
        F.when(F.col("error").isNull(), "stored").otherwise("dead letter").alias("outcome"),
        F.coalesce("error", F.lit("")).alias("error_msg"),
    )


RETRY_SQL = f"""
SELECT doc_id, CASE WHEN text LIKE '%{REFUSED}%' THEN 'dead letter' ELSE 'stored' END AS outcome,
       CASE WHEN text LIKE '%{REFUSED}%' THEN '{embed.GAVE_UP}' ELSE '' END AS error_msg
FROM documents
"""


def vector_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of label 0 miss a component and do not fit the table."""
    e = si.table(spark, sf_dir, "embeddings")
    short = F.slice("embedding", F.lit(1), F.size("embedding") - 1)
    points = e.select(
        "vec_id", F.when(F.col("label") == 0, short).otherwise(F.col("embedding")).alias("vector")
    )
    fitting, misfits = vectors.split_by_dimension(points, 64)
    return fitting.select("vec_id", F.lit("").alias("error_msg")).unionByName(
        misfits.select("vec_id", F.lit(vectors.WRONG_SIZE).alias("error_msg"))
    )


DIM_SQL = f"""
SELECT vec_id, CASE WHEN label = 0 THEN '{vectors.WRONG_SIZE}' ELSE '' END AS error_msg
FROM embeddings
"""


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors to the mean vector of each label."""
    e = si.table(spark, sf_dir, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))
    questions = means.groupBy(F.col("label").alias("question_id")).agg(
        F.transform(ordered, lambda p: p["x"]).alias("vector")
    )
    points = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    hits = search.nearest(questions, points, search.ASK_LIMIT, 64)
    return hits.select("question_id", "id", "rank", "score")


TOPK_SQL = """
WITH part AS (SELECT label, generate_subscripts(embedding, 1) AS pos,
                     unnest(embedding)::DOUBLE AS x FROM embeddings),
     mean AS (SELECT label, pos, avg(x) AS x FROM part GROUP BY ALL),
     question AS (SELECT label, list(x ORDER BY pos) AS v FROM mean GROUP BY label),
     scored AS (SELECT question.label AS question_id, vec_id AS id,
                       round(list_cosine_similarity(v, embedding::DOUBLE[]), 9) AS score
                FROM question CROSS JOIN embeddings)
SELECT question_id, id, rank, score
FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id)::INTEGER
                  AS rank FROM scored)
WHERE rank <= 3
"""


def batch_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = lakes.vector_table(spark, sf_dir)
    hits = search.nearest(_questions(spark, sf_dir), table, search.ASK_LIMIT, DIMENSION)
    return hits.select("question_id", "id", "rank", "score")


RETRIEVAL_SQL = si.with_ctes(
    "SELECT question_id, id, rank, score FROM hits WHERE rank <= 3",
    *_SEARCH_CTES,
)


def _found(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    table = lakes.vector_table(spark, sf_dir)
    return search.search(_questions(spark, sf_dir), table, k, DIMENSION)


def search_result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _found(spark, sf_dir, search.SEARCH_LIMIT)
    return rows.drop("id")


_ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
RESULT_SQL = si.with_ctes(
    f"""
SELECT question_id, rank, title, content, url, source,
       coalesce(strftime(published_at, {_ISO}), '') AS published_at, score
FROM hits JOIN article USING (id)
""",
    *_SEARCH_CTES,
)


def url_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored row of the newest article's URL."""
    table = lakes.vector_table(spark, sf_dir)
    newest = table.where("url <> ''").agg(F.max_by("url", F.struct("published_at", "url"))).first()
    found = dedup.find_url(table, newest[0] or "")
    return found.select("id", "url", "title", "source")


LOOKUP_SQL = si.with_ctes(
    """
SELECT id, url, title, source FROM article WHERE url <> '' AND published_at IS NOT NULL
ORDER BY published_at DESC, url DESC LIMIT 1
""",
    *_ARTICLE_CTES,
)


def context_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.context(_found(spark, sf_dir, search.ASK_LIMIT))


_ENTRY_SQL = (
    f"'[' || CASE WHEN title = '' THEN '{text.NO_TITLE}' ELSE title END || ']' || chr(10) || content"
)
_RULE_SQL = "chr(10) || chr(10) || '---' || chr(10) || chr(10)"
_CONTEXT_SQL = f"""
context AS (
  SELECT question_id, array_to_string(list({_ENTRY_SQL} ORDER BY rank), {_RULE_SQL}) AS context,
         count(*) AS n_hits
  FROM hits JOIN article USING (id) WHERE rank <= 3 GROUP BY question_id)"""
CONTEXT_SQL = si.with_ctes(
    "SELECT question_id, context, n_hits FROM context", *_SEARCH_CTES, _CONTEXT_SQL
)


def reference_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of two searches per question, the second one shorter."""
    hits = _found(spark, sf_dir, search.ASK_LIMIT)
    calls = hits.withColumn("call", F.lit(1)).unionByName(
        hits.where("rank <= 2").withColumn("call", F.lit(2))
    )
    listed = retrieval.references(calls, "call")
    return listed.select("question_id", F.to_json("reference_news").alias("reference_news"))


REFERENCE_SQL = si.with_ctes(
    f"""
SELECT question_id,
       to_json(list({{'title': title, 'url': url, 'source': source,
                      'published_at': coalesce(strftime(published_at, {_ISO}), ''),
                      'score': score}} ORDER BY call, rank))::VARCHAR AS reference_news
FROM (SELECT *, 1 AS call FROM hits WHERE rank <= 3
      UNION ALL SELECT *, 2 AS call FROM hits WHERE rank <= 2)
JOIN article USING (id) GROUP BY question_id
""",
    *_SEARCH_CTES,
)


def context_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question with its context; those that the embedder refuses cannot be searched and say so."""
    asked = si.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")
    questions = embed.with_vectors(asked, Refusing(DIMENSION), "text", _NO_WAIT)
    searched = questions.where("error IS NULL")
    table = lakes.vector_table(spark, sf_dir)
    hits = search.search(searched, table, search.ASK_LIMIT, DIMENSION)
    return retrieval.context_or_default(questions, retrieval.context(hits))


DEFAULT_SQL = si.with_ctes(
    f"""
SELECT item_id AS question_id, coalesce(n_hits, 0)::BIGINT AS n_hits,
       coalesce(context, CASE WHEN text LIKE '%{REFUSED}%' THEN '{retrieval.SEARCH_FAILED}'
                              ELSE '{retrieval.NOTHING_FOUND}' END) AS context
FROM benchmark LEFT JOIN (
  SELECT question_id, array_to_string(list({_ENTRY_SQL} ORDER BY rank), {_RULE_SQL}) AS context,
         count(*) AS n_hits
  FROM hits JOIN article USING (id) JOIN (SELECT item_id, text FROM benchmark) AS b
    ON b.item_id = question_id
  WHERE rank <= 3 AND b.text NOT LIKE '%{REFUSED}%' GROUP BY question_id)
ON question_id = item_id
""",
    *_SEARCH_CTES,
)


def market_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lakes.silver(spark, sf_dir)
    recent = trade_ops.average_price(trade_ops.recent(t, lakes.newest_trade_hour(spark, sf_dir)))
    last = trade_ops.latest_price(t).select("latest_price")
    total = trade_ops.volume(t).select("quantity")
    stats = recent.select(
        "avg_price", "n_trades", last.scalar().alias("latest_price"), total.scalar().alias("volume")
    )
    return retrieval.brief(context_assembly(spark, sf_dir), stats)


BRIEF_SQL = si.with_ctes(
    """
SELECT question_id, context, n_hits,
       (SELECT round(avg(price), 6) FROM recent) AS avg_price,
       (SELECT count(*) FROM recent) AS n_trades,
       (SELECT arg_max(price, (trade_time, trade_id)) FROM silver) AS latest_price,
       (SELECT round(sum(quantity), 6) FROM silver) AS volume
FROM context
""",
    *_SEARCH_CTES, _CONTEXT_SQL, si.EV, si.SILVER,
    """
recent AS (SELECT * FROM silver
           WHERE trade_time >= (SELECT max(trade_time) FROM silver) - INTERVAL 1 HOUR)""",
)


def transcript_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = retrieval.transcript(si.table(spark, sf_dir, "conversations"))
    return pages.select("conv_id", "page", F.to_json("turns").alias("turns"))


TRANSCRIPT_SQL = f"""
SELECT conv_id, page,
       to_json(list({{'turn': turn, 'role': role, 'text': text}} ORDER BY turn))::VARCHAR AS turns
FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)
                // {retrieval.TURNS_PER_PAGE} AS page FROM conversations)
GROUP BY conv_id, page
"""


def _fingerprint(vector: str = "vector"):
    """What a comparison shows of a vector: its non-zero components, and a sum that weighs each by its place."""
    placed = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(placed, F.lit(0.0), lambda a, x: a + x)
    return F.size(F.filter(vector, lambda x: x != 0)).alias("n_slots"), F.round(total, 4).alias("weighed")


_FINGERPRINT_SQL = "count(*)::INTEGER AS n_slots, round(sum((slot + 1) * x), 4) AS weighed"


def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles by one writer, those of labelled documents again by another, both as their batch 0, and one of these batches twice."""
    a = si.raw_articles(spark, sf_dir).withColumn("url", F.coalesce("link", F.lit("")))
    unique = dedup.one_per_id(a, "doc_id")
    root = scratch_path(spark, "upsert")
    stored_at = si.anchor().cast("string")

    def store(articles: DataFrame, writer: str) -> None:
        embedded = embed.with_vectors(articles, embed.HashedWords(DIMENSION), "title")
        vectors.upsert(vectors.article_points(embedded, stored_at), root, 0, writer)

    store(unique, "batch")
    labelled = si.table(spark, sf_dir, "labels").select("doc_id").distinct()
    again = unique.join(labelled, "doc_id", "left_semi").withColumn("title", F.concat(F.lit("updated: "), F.col("title")))
    for _ in range(2):  # the second time replaces the first
        store(again, "stream")
    now = vectors.current(spark, root)
    return now.select("id", "title", "content", "url", "version", *_fingerprint())


UPSERT_SQL = si.with_ctes(
    f"""
SELECT id, title, content, url, version, coalesce(n_slots, 0) AS n_slots, coalesce(weighed, 0.0) AS weighed
FROM stored LEFT JOIN (SELECT key, {_FINGERPRINT_SQL} FROM sv GROUP BY key) ON key = id
""",
    si.DOC,
    """
stored AS (
  SELECT id, CASE WHEN is_new THEN 'updated: ' || title ELSE title END AS title, content, url,
         CASE WHEN is_new THEN 1 ELSE 0 END::BIGINT AS version
  FROM (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS is_new
        FROM (SELECT doc_id, title, content, coalesce(link, '') AS url, md5(coalesce(link, content)) AS id,
                     row_number() OVER (PARTITION BY coalesce(link, content) ORDER BY doc_id) AS rn
              FROM doc) WHERE rn = 1))""",
    _vectors_cte("sv", "stored", "id", "title"),
)


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = news.refine(si.spread_articles(spark, sf_dir), "doc_id", anchor=si.anchor())
    loaded = loaded.withColumn("url", F.coalesce("link", F.lit("")))
    fresh = ingest_job.new_articles(loaded, si.stored_articles(spark, sf_dir), "doc_id")
    chunks = fresh.select(F.size(chunk.fixed_chunks(F.col("content"))).alias("n_chunks"))
    return metrics.ingest_metrics(loaded, chunks)


_N_CHUNKS = "greatest(ceil((length(content) - 100) / 600.0), 1)"
METRICS_SQL = si.with_ctes(
    f"""
SELECT 'success' AS status, (SELECT count(*) FROM refined) AS articles_loaded,
       count(*) AS articles_processed,
       (SELECT count(*) FROM identified) - count(*) AS articles_skipped,
       sum({_N_CHUNKS})::BIGINT AS chunks_uploaded
FROM article WHERE link IS NULL OR link NOT IN (SELECT url FROM stored)
""",
    *_ARTICLE_CTES, si.STORED,
)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one vector table: the first hour, everything, everything
    again."""
    si.use_utc(spark)
    refined, root = lakes.refined_root(spark, sf_dir), scratch_path(spark, "incremental")
    first_hour = {"year": 2024, "month": 1, "day": 1, "hour": 0}
    reports = None
    for run, part in enumerate((first_hour, {}, {})):
        report = ingest_job.ingest_slice(
            spark, refined, root, run, embed.HashedWords(DIMENSION),
            si.anchor().cast("string"), chunk.fixed_chunks, **part,
        )
        report = report.drop("target_path").withColumn("run", F.lit(run))
        reports = report if reports is None else reports.unionByName(report)
    return reports


INCREMENTAL_SQL = si.with_ctes(
    f"""
SELECT 0 AS run, 'success' AS status, count(*) AS articles_loaded,
       count(CASE WHEN first_in_hour THEN 1 END) AS articles_processed,
       count(CASE WHEN content <> '' AND NOT first_in_hour THEN 1 END) AS articles_skipped,
       sum(CASE WHEN first_in_hour THEN {_N_CHUNKS} ELSE 0 END)::BIGINT AS chunks_uploaded
FROM ranked WHERE in_hour
UNION ALL
SELECT 1 AS run, 'success' AS status, count(*) AS articles_loaded,
       count(CASE WHEN fresh THEN 1 END) AS articles_processed,
       count(CASE WHEN content <> '' AND NOT fresh THEN 1 END) AS articles_skipped,
       sum(CASE WHEN fresh THEN {_N_CHUNKS} ELSE 0 END)::BIGINT AS chunks_uploaded
FROM (SELECT *, content <> '' AND rn = 1
               AND (link IS NULL OR link NOT IN (SELECT link FROM ranked
                                                 WHERE first_in_hour AND link IS NOT NULL)) AS fresh
      FROM ranked)
UNION ALL
SELECT 2 AS run, 'success' AS status, count(*) AS articles_loaded,
       count(CASE WHEN content <> '' AND rn = 1 AND link IS NULL THEN 1 END)
         AS articles_processed,
       count(CASE WHEN content <> '' AND NOT (rn = 1 AND link IS NULL) THEN 1 END)
         AS articles_skipped,
       sum(CASE WHEN content <> '' AND rn = 1 AND link IS NULL THEN {_N_CHUNKS} ELSE 0 END)
         ::BIGINT AS chunks_uploaded
FROM ranked
""",
    *_ARTICLE_CTES,
    """
ranked AS (
  SELECT *, in_hour AND content <> '' AND hour_rn = 1 AS first_in_hour
  FROM (SELECT *, row_number() OVER (PARTITION BY content = '', id
                    ORDER BY published_at NULLS FIRST, title, content) AS rn,
               row_number() OVER (PARTITION BY content = '', id, in_hour
                    ORDER BY published_at NULLS FIRST, title, content) AS hour_rn
        FROM (SELECT *, md5(coalesce(link, content)) AS id,
                     year = 2024 AND month = 1 AND day = 1 AND hour = 0 AS in_hour
              FROM refined)))""",
)


def batch_vector_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector table after an ingest of the whole refined lake."""
    si.use_utc(spark)
    root = scratch_path(spark, "batch-ingest")
    ingest_job.ingest_slice(
        spark, lakes.refined_root(spark, sf_dir), root, 0, embed.HashedWords(DIMENSION),
        si.anchor().cast("string"),
    )
    table = vectors.current(spark, root)
    return table.select(
        "id", "url", "chunk_index", F.length("content").alias("n_chars"),
        F.size("vector").alias("dimension"),
    )


def sql_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of five kinds, one per event."""
    e = si.table(spark, sf_dir, "events")
    n = F.col("event_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")

    def around(before: str, after: str = ""):
        return F.concat(F.lit(before), n, F.lit(after))

    statement = (
        F.when(kind == "view", around("SELECT avg(price) AS created_at FROM trades WHERE trade_id > "))
        .when(kind == "click", around("with t as (select * from trades where trade_id = ", ") select 1 from t"))
        .when(kind == "purchase", around("DELETE FROM trades WHERE trade_id = "))
        .when(kind == "signup", around("SELECT * FROM parquet.`/data/", "`"))
        .when(k < 50, around("SELECT 'drop; it''s' AS note, /* delete */ ", " AS n FROM trades -- alter"))
        .otherwise(around("SELECT ", "; DROP TABLE trades"))
    )
    return e.select("event_id", sqltool.read_only(statement).alias("is_allowed"))


GUARD_SQL = """
SELECT event_id, event_type IN ('view', 'click')
       OR (event_type = 'error' AND json_extract_string(props, '$.k')::INTEGER < 50) AS is_allowed
FROM events
"""


def sql_tool_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    return sqltool.query_trades(
        spark,
        "SELECT side, count(*) AS n_trades, round(avg(price), 4) AS avg_price,"
        " max(trade_time) AS last_time FROM trades GROUP BY side",
        lakes.silver_root(spark, sf_dir),
    )


TOOL_SQL = si.with_ctes(
    f"""
SELECT to_json({{'side': side, 'n_trades': count(*), 'avg_price': round(avg(price), 4),
                 'last_time': strftime(max(trade_time), {_ISO})}})::VARCHAR AS record
FROM silver GROUP BY side
""",
    si.EV, si.SILVER,
)


def sql_result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    return sqltool.query_trades(
        spark,
        "SELECT trade_id, price, quantity, side, trade_time FROM trades",
        lakes.silver_root(spark, sf_dir),
    )


RECORDS_SQL = si.with_ctes(
    f"""
SELECT to_json({{'trade_id': trade_id, 'price': price, 'quantity': quantity, 'side': side,
                 'trade_time': strftime(trade_time, {_ISO})}})::VARCHAR AS record
FROM silver
""",
    si.EV, si.SILVER,
)

def _searching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table as a frame of a session of its own, in which functions can be defined."""
    return lakes.vector_table(sqltool.isolated_session(spark), sf_dir)


def search_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question, the longest of the benchmark, asked in SQL."""
    table = _searching(spark, sf_dir)
    session = table.sparkSession
    asked = si.table(session, sf_dir, "benchmark").where("text IS NOT NULL")
    question = asked.orderBy(F.length("text").desc(), "item_id").select("text").first()
    search_sql.register_search(session, table, embed.HashedWords(DIMENSION), DIMENSION)
    return session.sql("SELECT * FROM search_news(:q, 5)", {"q": question["text"] if question else ""})


_FOUND_SQL = f"""rank, id, title, content, url, source, coalesce(strftime(published_at, {_ISO}), '') AS published_at, score"""
SEARCH_NEWS_SQL = si.with_ctes(
    f"""
SELECT {_FOUND_SQL} FROM hits JOIN article USING (id)
WHERE question_id = (SELECT item_id FROM benchmark ORDER BY length(text) DESC NULLS LAST, item_id LIMIT 1)
""",
    *_SEARCH_CTES,
)


def search_news_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question of the benchmark, lateral over its table."""
    table = _searching(spark, sf_dir)
    session = table.sparkSession
    asked = si.table(session, sf_dir, "benchmark")
    search_sql.register_questions(session, table, asked, embed.HashedWords(DIMENSION), DIMENSION)
    asked.createOrReplaceTempView("asked")
    return session.sql("SELECT asked.item_id AS question_id, found.* FROM asked, LATERAL search_news_of(asked.text, 3) AS found")


LATERAL_SQL = si.with_ctes(
    f"SELECT question_id, {_FOUND_SQL} FROM hits JOIN article USING (id) WHERE rank <= 3", *_SEARCH_CTES
)


def sql_result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered answer as files, read back with each record's place."""
    si.use_utc(spark)
    path = scratch_path(spark, "answer")
    sql = "SELECT symbol, trade_id, price FROM trades ORDER BY price DESC, trade_id, symbol"
    failed = sqltool.answer_to_files(spark, sql, lakes.silver_root(spark, sf_dir), path)
    if failed:
        raise RuntimeError(failed)
    return sqltool.answer(spark, path)


PAGES_SQL = si.with_ctes(
    """
SELECT to_json({'symbol': symbol, 'trade_id': trade_id, 'price': price})::VARCHAR AS record,
       row_number() OVER (ORDER BY price DESC, trade_id, symbol) AS place
FROM silver
""",
    si.EV, si.SILVER,
)


def transcript_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as one transcript of any length, written as ordered files and read back."""
    turns = si.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "transcripts")
    retrieval.write_transcripts(turns, path)
    return retrieval.transcripts(spark, path, turns.schema)


TRANSCRIPT_RECORD_SQL = """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position,
       count(*) OVER (PARTITION BY conv_id) AS n_turns, turn, role, text
FROM conversations
"""

QUERIES = {
    "embed_hashed": (embed_hashed, EMBED_SQL),
    "embed_retry_dlq": (embed_retry_dlq, RETRY_SQL),
    "vector_dim_check": (vector_dim_check, DIM_SQL),
    "vector_topk": (vector_topk, TOPK_SQL),
    "batch_retrieval": (batch_retrieval, RETRIEVAL_SQL),
    "search_result_rows": (search_result_rows, RESULT_SQL),
    "url_lookup": (url_lookup, LOOKUP_SQL),
    "context_assembly": (context_assembly, CONTEXT_SQL),
    "reference_list": (reference_list, REFERENCE_SQL),
    "context_or_default": (context_or_default, DEFAULT_SQL),
    "market_brief": (market_brief, BRIEF_SQL),
    "transcript_assembly": (transcript_assembly, TRANSCRIPT_SQL),
    "vector_upsert": (vector_upsert, UPSERT_SQL),
    "ingest_metrics": (ingest_metrics, METRICS_SQL),
    "incremental_ingest": (incremental_ingest, INCREMENTAL_SQL),
    "batch_vector_ingest": (batch_vector_ingest, None),
    "sql_guard": (sql_guard, GUARD_SQL),
    "sql_tool_result": (sql_tool_result, TOOL_SQL),
    "sql_result_json": (sql_result_json, RECORDS_SQL),
    "search_news": (search_news, SEARCH_NEWS_SQL),
    "search_news_lateral": (search_news_lateral, LATERAL_SQL),
    "sql_result_pages": (sql_result_pages, PAGES_SQL),
    "transcript_record": (transcript_record, TRANSCRIPT_RECORD_SQL),
}
