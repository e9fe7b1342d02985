"""Article feeds: refinement, keys, filters, pages and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions import html, text, times
from newslake.operators import chunk, decode, dedup, main_text, metrics, news, publish, trades, url_filter
from newslake.operators.position import numbered
from newslake.operators.vectors import with_payload
from newslake.plans import lakes
from newslake.plans import stand_ins as si
from newslake.schemas import PARTITIONS, RAW_ARTICLE, REFINED_ARTICLE
from newslake.session import settle, spread
from newslake.sources import lake

# The hour that slice queries read.
SLICE = {"year": 2024, "month": 1, "day": 1, "hour": 0}
_PARTS = ", ".join(PARTITIONS)
_ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
_TRIM = si.SQL_WHITESPACE


def _refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.refine(si.spread_articles(spark, sf_dir), "doc_id", anchor=si.anchor())


def news_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.without_zone(_refined(spark, sf_dir))


REFINE_SQL = si.with_ctes("SELECT * FROM refined", si.DOC, si.REFINED)


def clean_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = si.spread_articles(spark, sf_dir)
    return articles.select("doc_id", text.clean_boilerplate(F.col("content")).alias("content"))


CLEAN_SQL = si.with_ctes(
    f"""
SELECT doc_id, trim(regexp_replace(content, {si.SQL_BOILERPLATE}, '', 'g'), {_TRIM}) AS content
FROM doc
""",
    si.DOC,
)


def source_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = text.source_label(F.col("source"), F.col("news_type"))
    return si.raw_articles(spark, sf_dir).select("doc_id", label.alias("source"))


LABEL_SQL = si.with_ctes("SELECT doc_id, source FROM refined", si.DOC, si.REFINED)


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = si.raw_articles(spark, sf_dir).select(
        "doc_id",
        times.parse_time(F.col("published_at")).alias("published_at"),
        times.parse_time(F.col("crawled_at")).alias("crawled_at"),
    )
    return si.without_zone(rows)


PARSE_SQL = si.with_ctes(
    "SELECT doc_id, published_ts AS published_at, crawled_ts AS crawled_at FROM doc", si.DOC
)


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = times.partition_parts(times.parse_time(F.col("published_at")), si.anchor())
    rows = si.raw_articles(spark, sf_dir)
    return rows.select("doc_id", *[parts[p].alias(p) for p in PARTITIONS])


PARTITION_SQL = si.with_ctes(f"SELECT doc_id, {_PARTS} FROM refined", si.DOC, si.REFINED)


def refined_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    return si.without_zone(lake.scan(spark, lakes.refined_root(spark, sf_dir), REFINED_ARTICLE))


ROUND_SQL = si.with_ctes("SELECT * EXCLUDE (doc_id) FROM refined", si.DOC, si.REFINED)


def partition_slice_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    return si.without_zone(lake.scan_slice(spark, lakes.refined_root(spark, sf_dir), **SLICE))


SLICE_SQL = si.with_ctes(
    """
SELECT title, content, link, published_at, source FROM refined
WHERE year = 2024 AND month = 1 AND day = 1 AND hour = 0
""",
    si.DOC, si.REFINED,
)


def full_ingest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    si.use_utc(spark)
    return si.without_zone(lake.scan_slice(spark, lakes.refined_root(spark, sf_dir)))


FULL_SQL = si.with_ctes(
    "SELECT title, content, link, published_at, source FROM refined", si.DOC, si.REFINED
)


def partition_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is there refined news for each hour that has trades?"""
    si.use_utc(spark)
    silver, refined = lakes.silver_root(spark, sf_dir), lakes.refined_root(spark, sf_dir)
    rows = [(*part, lake.slice_exists(spark, refined, *part)) for part in lake.hours(spark, silver)]
    return spark.createDataFrame(rows, ", ".join([*(f"{p} int" for p in PARTITIONS), "is_filled boolean"]))


EXISTS_SQL = si.with_ctes(
    f"""
SELECT {_PARTS}, ({_PARTS}) IN (SELECT ({_PARTS}) FROM refined) AS is_filled
FROM (SELECT DISTINCT {si.parts_of("trade_time")} FROM silver)
""",
    si.EV, si.SILVER, si.DOC, si.REFINED,
)


def news_raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.refined_messages(_refined(spark, sf_dir), "doc_id")


PAYLOAD_SQL = si.with_ctes(
    f"""
SELECT doc_id, to_json({{'title': title, 'link': link,
         'published_at': strftime(published_at, {_ISO}), 'content': content,
         'content_length': content_length, 'crawled_at': strftime(crawled_at, {_ISO}),
         'source': source, 'min': min, 'year': year, 'month': month, 'day': day,
         'hour': hour}})::VARCHAR AS value
FROM refined
""",
    si.DOC, si.REFINED,
)


def keyed_article_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole articles as keyed messages. The breaking feed has no page per article, so its
    key is title, clock and place on the page crawled in that hour."""
    a = si.raw_articles(spark, sf_dir).withColumn("at", times.parse_time(F.col("crawled_at")))
    a = a.withColumn("page", F.date_trunc("hour", "at"))
    a = numbered(a, ["page", "source", "news_type"], ["doc_id"], "place")
    clock = F.date_format("at", "HH:mm")
    breaking = F.coalesce(F.col("news_type") == "breaking", F.lit(False))
    link = F.when(~breaking, F.col("link"))
    key = publish.article_key(link, F.col("title"), clock, F.col("place"))
    fields = publish.as_json(a, "title", "link", "published_at", "content", "content_length", "crawled_at", "source", "news_type")
    return a.select("doc_id", key.alias("key"), fields.alias("value"))


KEYED_SQL = si.with_ctes(
    f"""
SELECT doc_id,
       CASE WHEN news_type IS DISTINCT FROM 'breaking' AND link IS NOT NULL THEN link
            ELSE title || '_' || strftime(crawled_ts, '%H:%M') || '_'
                 || row_number() OVER (PARTITION BY date_trunc('hour', crawled_ts), source,
                                       news_type ORDER BY doc_id) END AS key,
       to_json({{'title': title, 'link': link, 'published_at': published_at, 'content': content, 'content_length': length(content),
                'crawled_at': strftime(crawled_ts, {_ISO}), 'source': source, 'news_type': news_type}})::VARCHAR AS value
FROM doc
""",
    si.DOC,
)


def backfill_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that sends four columns only gets all eight."""
    few = si.raw_articles(spark, sf_dir).select("doc_id", "title", "link", "content", "source")
    full = decode.backfill(few)
    return full.select(
        "doc_id", "title", "source",
        F.coalesce("content_length", F.lit(-1)).alias("content_length"),
        *[F.coalesce(c, F.lit("-")).alias(c) for c in ("published_at", "crawled_at", "news_type")],
        F.lit(set(RAW_ARTICLE.fieldNames()) <= set(full.columns)).alias("is_complete"),
    )


BACKFILL_SQL = si.with_ctes(
    """
SELECT doc_id, title, source, -1 AS content_length, '-' AS published_at, '-' AS crawled_at,
       '-' AS news_type, true AS is_complete
FROM doc
""",
    si.DOC,
)


def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds, each with the columns it has: one without types, one without
    links, one with an author."""
    a = si.raw_articles(spark, sf_dir)
    kind = F.col("news_type")
    first = a.where(kind.isNull()).drop("news_type")
    second = a.where(kind == "breaking").drop("link")
    third = a.where((kind == "newsroom") | (kind == "")).withColumn("author", F.col("source"))
    feeds = news.union_feeds(first, second, third)
    return feeds.select("doc_id", "title", "link", "source", "news_type", "author")


UNION_SQL = si.with_ctes(
    """
SELECT doc_id, title, CASE WHEN news_type = 'breaking' THEN NULL ELSE link END AS link, source,
       news_type, CASE WHEN news_type IN ('newsroom', '') THEN source END AS author
FROM doc
""",
    si.DOC,
)


def url_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``link``, else a ``url`` that every third article has, else ''."""
    a = si.raw_articles(spark, sf_dir)
    url = F.when(F.col("source") == "coindesk", F.concat(F.lit("urn:"), F.col("doc_id")))
    return a.select("doc_id", text.article_url(F.col("link"), url).alias("url"))


URL_SQL = si.with_ctes(
    """
SELECT doc_id, CASE WHEN link IS NOT NULL THEN link
                    WHEN source = 'coindesk' THEN 'urn:' || doc_id ELSE '' END AS url
FROM doc
""",
    si.DOC,
)


def drop_empty_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.with_content(si.raw_articles(spark, sf_dir)).select("doc_id", "content_length")


EMPTY_SQL = si.with_ctes(
    "SELECT doc_id, length(content)::INTEGER AS content_length FROM doc WHERE content <> ''", si.DOC
)


def require_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.with_link(si.raw_articles(spark, sf_dir)).select("doc_id", "link")


LINK_SQL = si.with_ctes("SELECT doc_id, link FROM doc WHERE link IS NOT NULL", si.DOC)


def title_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title from the page, empty for ``coindesk``; listed title, absent without a
    link."""
    a = si.raw_articles(spark, sf_dir)
    extracted = F.when(F.col("source") == "coindesk", "").otherwise(F.col("title"))
    listed = F.when(F.col("link").isNotNull(), F.concat(F.lit("listed: "), F.col("title")))
    return a.select("doc_id", news.pick_title(extracted, listed).alias("title"))


TITLE_SQL = si.with_ctes(
    f"""
SELECT doc_id, CASE WHEN source <> 'coindesk' AND title <> '' THEN title
                    WHEN link IS NOT NULL THEN 'listed: ' || title
                    ELSE '{text.NO_TITLE}' END AS title
FROM doc
""",
    si.DOC,
)


def content_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.length("text").alias("content_length"))


LENGTH_SQL = "SELECT doc_id, length(text)::INTEGER AS content_length FROM documents"


def timestamp_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return si.table(spark, sf_dir, "events").select(
        "event_id", times.iso(at).alias("iso"), times.display(at).alias("display")
    )


FORMAT_SQL = f"""
SELECT event_id, strftime(ts, {_ISO}) AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS display
FROM events
"""


def timestamp_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = F.col("published_at")
    return si.raw_articles(spark, sf_dir).select(
        "doc_id",
        times.iso_or_raw(published).alias("published_at"),
        times.display_or_raw(published).alias("published_at_display"),
    )


FALLBACK_SQL = si.with_ctes(
    """
SELECT doc_id, published_at,
       coalesce(strftime(published_ts, '%Y-%m-%d %H:%M:%S UTC'), published_at)
         AS published_at_display
FROM doc
""",
    si.DOC,
)


def _crawl_since(spark: SparkSession, sf_dir: str) -> Column:
    """Start of the window that ends with the newest crawl."""
    newest = trades.newest_time(
        si.raw_articles(spark, sf_dir).select(times.parse_time(F.col("crawled_at")).alias("at")), "at"
    )
    return news.window_start(F.lit(newest))


_SINCE_SQL = f"(SELECT max(crawled_ts) FROM doc) - INTERVAL {news.LOOKBACK_MINUTES} MINUTE"


def since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = _crawl_since(spark, sf_dir)
    return news.published_after(si.raw_articles(spark, sf_dir), since).select("doc_id", "title")


SINCE_SQL = si.with_ctes(
    f"SELECT doc_id, title FROM doc WHERE published_ts > {_SINCE_SQL}", si.DOC
)


def since_filter_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = _crawl_since(spark, sf_dir)
    kept = news.published_after(si.raw_articles(spark, sf_dir), since, lenient=True)
    return kept.select("doc_id", "title")


LENIENT_SQL = si.with_ctes(
    f"SELECT doc_id, title FROM doc WHERE published_ts IS NULL OR published_ts > {_SINCE_SQL}",
    si.DOC,
)


def latest_n_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = news.latest(_refined(spark, sf_dir), news.FEED_LIMIT, "doc_id")
    return si.without_zone(rows.select("doc_id", "title", "published_at"))


LATEST_SQL = si.with_ctes(
    f"""
SELECT doc_id, title, published_at FROM refined
ORDER BY published_at DESC NULLS LAST, doc_id LIMIT {news.FEED_LIMIT}
""",
    si.DOC, si.REFINED,
)


def feed_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles before the window are skipped; without text or link they fail."""
    since = _crawl_since(spark, sf_dir)
    a = si.raw_articles(spark, sf_dir)
    failed = (F.col("content") == "") | F.col("link").isNull()
    status = (
        F.when(times.parse_time(F.col("published_at")) <= since, "skipped")
        .when(failed, "failed").otherwise("success")
    )
    return metrics.feed_counts(a.withColumn("status", status))


STATUS_SQL = si.with_ctes(
    f"""
SELECT source, count(CASE WHEN status = 'success' THEN 1 END) AS success,
       count(CASE WHEN status = 'failed' THEN 1 END) AS failed,
       count(CASE WHEN status = 'skipped' THEN 1 END) AS skipped, count(*) AS total
FROM (SELECT source, CASE WHEN published_ts <= {_SINCE_SQL} THEN 'skipped'
                          WHEN content = '' OR link IS NULL THEN 'failed'
                          ELSE 'success' END AS status FROM doc)
GROUP BY source
""",
    si.DOC,
)


def deterministic_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = si.raw_articles(spark, sf_dir)
    return a.select("doc_id", text.article_id(F.col("link"), F.col("content")).alias("id"))


ID_SQL = si.with_ctes("SELECT doc_id, md5(coalesce(link, content)) AS id FROM doc", si.DOC)


def vector_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _refined(spark, sf_dir).withColumn("url", F.col("link"))
    paid = with_payload(rows, times.iso(si.anchor()))
    return si.without_zone(paid.select("doc_id", "title", "source", "published_at", "url", "ingested_at"))


VECTOR_PAYLOAD_SQL = si.with_ctes(
    f"""
SELECT doc_id, title, source, published_at, coalesce(link, '') AS url,
       strftime(TIMESTAMP '{si.ANCHOR}', {_ISO}) AS ingested_at
FROM refined
""",
    si.DOC, si.REFINED,
)


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.raw_articles(spark, sf_dir).select("doc_id", F.coalesce("link", F.lit("")).alias("url"))


def url_dedup_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.not_stored(_incoming(spark, sf_dir), si.stored_articles(spark, sf_dir))


ANTI_SQL = si.with_ctes(
    """
SELECT doc_id, coalesce(link, '') AS url FROM doc
WHERE link IS NULL OR link NOT IN (SELECT url FROM stored)
""",
    si.DOC, si.STORED,
)


def url_dedup_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New articles, of which only those that a filter of the stored URLs suspects are compared with them."""
    stored = si.stored_articles(spark, sf_dir)
    bucket = F.pmod(F.xxhash64("url"), F.lit(64))
    filters = settle(url_filter.url_filter(stored, bucket), "url-filter")
    return url_filter.not_stored_filtered(_incoming(spark, sf_dir), stored, filters, bucket)


def url_dedup_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.already_stored(_incoming(spark, sf_dir), si.stored_articles(spark, sf_dir))


SEMI_SQL = si.with_ctes(
    "SELECT doc_id, link AS url FROM doc WHERE link IN (SELECT url FROM stored)", si.DOC, si.STORED
)


def url_dedup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.one_per_url(_incoming(spark, sf_dir), "doc_id")


BATCH_SQL = si.with_ctes(
    """
SELECT doc_id, coalesce(link, '') AS url
FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY doc_id) AS rn FROM doc)
WHERE link IS NULL OR rn = 1
""",
    si.DOC,
)


def chunk_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.spread_documents(spark, sf_dir).select("doc_id", F.col("text").alias("content"))
    rows = chunk.chunk_rows(d, chunk.fixed_chunks(F.col("content")))
    return rows.select("doc_id", "chunk_index", "content")


_CHUNKS_SQL = """
  SELECT doc_id, i::INTEGER AS chunk_index, substr(text, i * 600 + 1, 700) AS content, text, link
  FROM (SELECT doc_id, text, link,
               unnest(range(greatest(ceil((length(text) - 100) / 600.0)::BIGINT, 1))) AS i
        FROM (SELECT d.doc_id, d.text, coalesce(doc.link, '') AS link
              FROM documents d JOIN doc USING (doc_id)) WHERE length(text) > 0)"""
FIXED_SQL = si.with_ctes(
    f"SELECT doc_id, chunk_index, content FROM ({_CHUNKS_SQL})", si.DOC
)


def chunk_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = si.raw_articles(spark, sf_dir).select("doc_id", "link").join(d, "doc_id")
    rows = joined.withColumnRenamed("text", "content")
    chunks = chunk.chunk_rows(rows, chunk.fixed_chunks(F.col("content")))
    made = text.chunk_id(F.col("link"), F.col("full_content"), F.col("chunk_index"))
    return chunks.select("doc_id", "chunk_index", made.alias("id"))


CHUNK_ID_SQL = si.with_ctes(
    f"""
SELECT doc_id, chunk_index,
       md5(CASE WHEN link = '' THEN text ELSE link END || '#' || chunk_index) AS id
FROM ({_CHUNKS_SQL})
""",
    si.DOC,
)


def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.spread_documents(spark, sf_dir).select("doc_id", F.col("text").alias("content"))
    rows = chunk.chunk_rows(d, chunk.separated_chunks(F.col("content")))
    return rows.select("doc_id", "chunk_index", "content")


def chunk_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text put together from its chunks, less what neighbours share; whether all chunks and shared parts keep their limits."""
    d = si.spread_documents(spark, sf_dir).select("doc_id", F.col("text").alias("content"))
    spans = d.withColumn("spans", chunk.separated_spans(F.col("content")))
    piece = F.expr("transform(spans, s -> struct(s.begin, s.upto, substring(content, s.begin + 1, s.upto - s.begin) AS chunk))")
    pieces = spans.select("doc_id", piece.alias("pieces"))
    # The chunk that follows adds what lies beyond the end of the one before.
    own = F.expr("transform(pieces, (p, i) -> substring(p.chunk, CASE WHEN i = 0 THEN 1 ELSE pieces[i - 1].upto - p.begin + 1 END, length(p.chunk)))")
    fits = F.expr(f"forall(pieces, p -> length(p.chunk) BETWEEN 1 AND {chunk.CHUNK_SIZE})")
    shared = F.expr(
        "forall(transform(pieces, (p, i) -> CASE WHEN i = 0 THEN 0 ELSE pieces[i - 1].upto - p.begin END), "
        f"n -> n BETWEEN 0 AND {chunk.CHUNK_OVERLAP})"
    )
    return pieces.select("doc_id", F.array_join(own, "").alias("content"), fits.alias("chunks_fit"), shared.alias("overlaps_fit"))


CHUNK_REBUILD_SQL = "SELECT doc_id, coalesce(text, '') AS content, true AS chunks_fit, true AS overlaps_fit FROM documents"


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed chunks of the refined articles with the fields they carry along."""
    articles = news.with_content(_refined(spark, sf_dir)).select(
        "doc_id", "source", "title", "content", F.col("link").alias("url"), "published_at"
    )
    rows = chunk.chunk_rows(articles, chunk.fixed_chunks(F.col("content")))
    return si.without_zone(rows)


CHUNK_ROWS_SQL = si.with_ctes(
    """
SELECT doc_id, source, title, url, published_at, content AS full_content,
       i::INTEGER AS chunk_index, substr(content, i * 600 + 1, 700) AS content
FROM (SELECT *, link AS url,
             unnest(range(greatest(ceil((length(content) - 100) / 600.0)::BIGINT, 1))) AS i
      FROM refined WHERE content <> '')
""",
    si.DOC, si.REFINED,
)


# --- pages --------------------------------------------------------------------

BODY_CLASS = "document-body"


def _article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the article in a body container, followed by a second one that
    holds the footer, as crawled pages have."""
    p = spread(si.table(spark, sf_dir, "pages"), "page_id")
    body = F.replace("html", F.lit("<article>"), F.lit('<div class="sc-1 document-body x">'))
    closed = F.replace(body, F.lit("</article>"), F.lit('</div><div class="document-body"><p>more</p>'))
    done = F.replace(closed, F.lit("</footer>"), F.lit("</footer></div>"))
    return p.select("page_id", "url", F.col("html").alias("page"), done.alias("html"))


def html_paragraph_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.with_body_text(_article_pages(spark, sf_dir), BODY_CLASS)
    return rows.select("page_id", "content")


# The character references that the given pages contain.
_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&copy;": "©",
    "&middot;": "·", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
}


def _sql_unescape(expression: str) -> str:
    for entity, char in _ENTITIES.items():
        entity, char = entity.replace("'", "''"), char.replace("'", "''")
        expression = f"replace({expression}, '{entity}', '{char}')"
    return f"regexp_replace({expression}, '&amp;?', '&', 'g')"  # cut titles end within a reference


def _sql_text(expression: str) -> str:
    stripped = f"regexp_replace({expression}, '<[^>]*>', '', 'g')"
    return f"trim({_sql_unescape(stripped)}, {_TRIM})"


_HIDDEN_SQL = (
    "regexp_replace({0}, '<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', '', 'gis')"
)
_BODY_CTE = f"""
body AS (
  SELECT page_id, split_part(split_part({_HIDDEN_SQL.format("html")}, '<article>', 2),
                             '</article>', 1) AS inner_html FROM pages),
paragraph AS (
  SELECT page_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS part
  FROM (SELECT page_id, regexp_split_to_array(inner_html, '<p(\\s[^>]*)?>') AS parts FROM body)),
visible AS (
  SELECT page_id, i,
         {_sql_text("regexp_split_to_array(part, '</p>|</?(div|article|section|main|nav|footer|header|aside|ul|ol|table|h[1-6])\\b[^>]*>')[1]")}
           AS content
  FROM paragraph WHERE i > 1)"""
PARAGRAPH_SQL = f"""
WITH {_BODY_CTE}
SELECT pages.page_id, coalesce(found.content, '') AS content
FROM pages LEFT JOIN (
  SELECT page_id, string_agg(content, ' ' ORDER BY i) AS content
  FROM visible WHERE content <> '' GROUP BY page_id) AS found USING (page_id)
"""


def html_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the stored pages and of a news block that stands in each before its article; its attributes stand in either
    quotes or none and in any order, and blocks of secure pages have a link."""
    p = spread(si.table(spark, sf_dir, "pages"), "page_id")
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    link = F.when(
        F.col("url").startswith("https"), F.concat(F.lit("<a rel=x data-at='1>0' href='"), F.col("url"), F.lit("'>more</a>"))
    ).otherwise("")
    block = F.concat(
        F.lit("<div id=b class='sc-9 BreakingNewsWrap'><div class=TimeBlock> 03&#58;22 </div>"),
        F.lit('<div class="BreakingNewsContentWrap"><div id="t" class=\'x BreakingNewsTitle\'><b>'), title,
        F.lit('</b> caf&eacute; &#8217;&#x27;</div><div class="BreakingNewsContents" title="a>b"><div>'), F.col("url"),
        F.lit("</div> "), title, F.lit("</div></div>"), link, F.lit("</div><article>"),
    )
    h = html.Page(F.col("_page"))
    placed = p.select("page_id", F.replace("html", F.lit("<article>"), block).alias("html"))
    return html.with_page(placed).select(
        "page_id",
        h.class_text("TimeBlock").alias("time"),
        h.class_text("BreakingNewsTitle").alias("title"),
        h.class_text("BreakingNewsContents").alias("content"),
        h.first_attribute("a", "data-at").alias("marked"),
        h.class_text("^ad$").alias("ad"),
        h.element_text("footer").alias("footer"),
        h.element_text("h1").alias("heading"),
        h.class_text("ArticleTitle").alias("absent"),
    )


_TITLE_SQL = "regexp_extract(html, '<title>(.*?)</title>', 1, 'is')"
FIELDS_SQL = f"""
SELECT page_id, '03:22' AS time, trim({_sql_unescape(_TITLE_SQL)} || ' café ’' || chr(39), {_TRIM}) AS title,
       {_sql_text("url || ' ' || " + _TITLE_SQL)} AS content,
       CASE WHEN url LIKE 'https%' THEN '1>0' END AS marked,
       {_sql_text("regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')")} AS ad,
       {_sql_text("regexp_extract(html, '<footer>(.*?)</footer>', 1, 's')")} AS footer,
       nullif({_sql_text("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")}, '') AS heading, NULL::VARCHAR AS absent
FROM pages
"""


def _described_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article pages with descriptions of their own in the head, the secure ones in another order of attributes."""
    p = _article_pages(spark, sf_dir)
    first = F.regexp_extract("url", "^[a-z]+://[^/]+/([^/?#]*)", 1)
    plain = F.concat(
        F.lit("<meta name='author' content='Ren&eacute; O&#8217;N'><meta property=\"og:site_name\" content=\"site of "), html.host(F.col("url")), F.lit('">'),
        F.lit("<meta content='a &amp; b' name=\"description\"><meta property=article:section content='"), first, F.lit("'>"),
        F.lit("<meta property='article:section' content=all><meta name=keywords content=' coin, "), first, F.lit(",, coin'>"),
    )
    secure = F.concat(F.lit("<meta content=\"2026-01-27T15:10:00Z\" data-x='>' property='article:published_time'>"), plain)
    head = F.when(F.col("url").startswith("https"), secure).otherwise(plain)
    return p.withColumn("html", F.replace("html", F.lit("<title>"), F.concat(head, F.lit("<title>"))))


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text and metadata; a page without text is skipped."""
    h = html.Page(F.col("_page"))
    found = html.with_page(_described_pages(spark, sf_dir)).select(
        "page_id",
        h.element_text("title").alias("rawtitle"),
        news.pick_title(h.element_text("h1"), h.element_text("title")).alias("title"),
        html.host(F.col("url")).alias("hostname"),
        h.language().alias("language"),
        h.meta_content("author").alias("author"),
        h.meta_content("description").alias("description"),
        h.meta_content("og:site_name").alias("sitename"),
        F.to_json(h.meta_contents("article:section")).alias("categories"),
        F.to_json(h.meta_list("keywords", "article:tag")).alias("tags"),
        h.meta_content("article:published_time").alias("date"),
        h.body_text(BODY_CLASS).alias("content"),
    )
    return news.with_content(found)


_FIRST_SQL = "regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1)"
METADATA_SQL = f"""
WITH {_BODY_CTE}
SELECT pages.page_id, nullif({_sql_text(_TITLE_SQL)}, '') AS rawtitle,
       coalesce(nullif({_sql_text("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 'is')")}, ''),
                nullif({_sql_text(_TITLE_SQL)}, ''), '{text.NO_TITLE}') AS title,
       regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS hostname,
       nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS language,
       'René O’N' AS author, 'a & b' AS description,
       'site of ' || regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS sitename,
       to_json(CASE WHEN {_FIRST_SQL} = '' THEN ['all'] ELSE [{_FIRST_SQL}, 'all'] END)::VARCHAR AS categories,
       to_json(CASE WHEN {_FIRST_SQL} IN ('', 'coin') THEN ['coin'] ELSE ['coin', {_FIRST_SQL}] END)::VARCHAR AS tags,
       CASE WHEN url LIKE 'https%' THEN '2026-01-27T15:10:00Z' END AS date, found.content
FROM pages JOIN (
  SELECT page_id, string_agg(content, ' ' ORDER BY i) AS content
  FROM visible WHERE content <> '' GROUP BY page_id) AS found USING (page_id)
"""


def page_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of the stored pages, found without any class name; menu, advertisement and footer are not part of it."""
    p = spread(si.table(spark, sf_dir, "pages"), "page_id")
    return main_text.with_main_text(p, "page_id").select("page_id", "content", "n_blocks")


MAIN_SQL = f"""
WITH parts AS (
  SELECT page_id, generate_subscripts(p, 1) AS i, unnest(p) AS part
  FROM (SELECT page_id, regexp_split_to_array(
          split_part(split_part({_HIDDEN_SQL.format("html")}, '<article>', 2), '</article>', 1),
          '</?(p|h[1-6]|ul|ol|li|table|div)(\\s[^>]*)?>') AS p FROM pages)),
blocks AS (
  SELECT page_id, i, trim(regexp_replace({_sql_unescape("regexp_replace(part, '<[^>]*>', '', 'g')")}, '[\\s\u00a0]+', ' ', 'g')) AS block
  FROM parts)
SELECT pages.page_id, coalesce(content, '') AS content, coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM pages LEFT JOIN (
  SELECT page_id, string_agg(block, chr(10) ORDER BY i) AS content, count(*) AS n_blocks
  FROM blocks WHERE block <> '' GROUP BY page_id) AS found USING (page_id)
"""

QUERIES = {
    "news_refine": (news_refine, REFINE_SQL),
    "clean_boilerplate": (clean_boilerplate, CLEAN_SQL),
    "source_label": (source_label, LABEL_SQL),
    "parse_timestamps": (parse_timestamps, PARSE_SQL),
    "partition_columns": (partition_columns, PARTITION_SQL),
    "refined_partition_roundtrip": (refined_partition_roundtrip, ROUND_SQL),
    "partition_slice_scan": (partition_slice_scan, SLICE_SQL),
    "full_ingest_scan": (full_ingest_scan, FULL_SQL),
    "partition_exists": (partition_exists, EXISTS_SQL),
    "news_raw_payload": (news_raw_payload, PAYLOAD_SQL),
    "keyed_article_messages": (keyed_article_messages, KEYED_SQL),
    "backfill_columns": (backfill_columns, BACKFILL_SQL),
    "union_feeds": (union_feeds, UNION_SQL),
    "url_coalesce": (url_coalesce, URL_SQL),
    "drop_empty_content": (drop_empty_content, EMPTY_SQL),
    "require_link": (require_link, LINK_SQL),
    "title_fallback": (title_fallback, TITLE_SQL),
    "content_length": (content_length, LENGTH_SQL),
    "timestamp_format": (timestamp_format, FORMAT_SQL),
    "timestamp_fallback": (timestamp_fallback, FALLBACK_SQL),
    "since_filter": (since_filter, SINCE_SQL),
    "since_filter_lenient": (since_filter_lenient, LENIENT_SQL),
    "latest_n_articles": (latest_n_articles, LATEST_SQL),
    "feed_status_counts": (feed_status_counts, STATUS_SQL),
    "deterministic_id": (deterministic_id, ID_SQL),
    "vector_payload": (vector_payload, VECTOR_PAYLOAD_SQL),
    "url_dedup_anti": (url_dedup_anti, ANTI_SQL),
    "url_dedup_filtered": (url_dedup_filtered, ANTI_SQL),
    "url_dedup_semi": (url_dedup_semi, SEMI_SQL),
    "url_dedup_batch": (url_dedup_batch, BATCH_SQL),
    "chunk_fixed": (chunk_fixed, FIXED_SQL),
    "chunk_id": (chunk_id, CHUNK_ID_SQL),
    "chunk_recursive": (chunk_recursive, None),
    "chunk_rebuild": (chunk_rebuild, CHUNK_REBUILD_SQL),
    "chunk_rows": (chunk_rows, CHUNK_ROWS_SQL),
    "html_paragraph_text": (html_paragraph_text, PARAGRAPH_SQL),
    "html_fields": (html_fields, FIELDS_SQL),
    "page_metadata": (page_metadata, METADATA_SQL),
    "page_main_text": (page_main_text, MAIN_SQL),
}
