"""Benchmark decontamination by winnowed fingerprints.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. An item's window
is ``WINDOW`` words in a row (all of them, if it has fewer). Of the hashes of all ``GRAM``-word grams, the least in
every ``WINDOW - GRAM + 1`` neighbouring ones is a fingerprint, so two texts that share a window share a
fingerprint, in that window. Documents are joined with the items on fingerprints; every hit is then extended: the windows
around it are compared word by word with the items' windows. Nothing shared of at least a window's length can be missed.

Items shorter than a window have no fingerprint of their own; their lengths (at most nine) are read from
the table, and documents are fingerprinted by all grams of those lengths as well.

All work is DataFrame expressions. Fingerprints are distinct per document before they leave the row; whichever side is
small enough by its written size is broadcast by the planner, otherwise both are shuffled.

Null text has no words. Items with a null id or without words are ignored; rows that repeat an item
id are one item with all their windows. Rows that repeat id and text get the same result each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.once import computed_once
from newslake.llm.common import text_or_empty
from newslake.session import settle

WINDOW, GRAM = 10, 5
SPAN = WINDOW - GRAM + 1  # grams in a window
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words() -> Column:
    return F.filter(F.split(F.translate(text_or_empty(), UPPER, LOWER), OTHER), lambda x: x != "")


def _positions(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(size: int) -> Column:
    w = F.col("w")
    return F.transform(_positions(F.size(w) - (size - 1)), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))


def _fingerprints() -> Column:
    """Distinct least hashes of all stretches of ``SPAN`` grams; column ``g`` holds the hashes."""
    g = F.col("g")
    return F.array_distinct(F.transform(_positions(F.size(g) - (SPAN - 1)), lambda i: F.least(*(F.get(g, i + k) for k in range(SPAN)))))


def _short(lengths: list[int]) -> Column:
    """Hashes of all grams of the given lengths."""
    if not lengths:
        return F.array().cast("array<bigint>")
    return F.array_distinct(F.concat(*(_gram_hashes(n) for n in lengths)))


def _window_text(start: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.col("w"), start + 1, size), " ")


def _short_starts(size: int) -> Column:
    """Where the grams of one short length are among the fingerprints found."""
    w = F.col("w")
    return F.filter(_positions(F.size(w) - (size - 1)), lambda s: F.array_contains(F.col("found"), F.xxhash64(*(F.get(w, s + k) for k in range(size)))))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, size, window): every window of every item as its words joined by spaces, and its item's size."""
    df = computed_once(items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), "text"), "w", _words())
    df = df.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(WINDOW)))
    df = df.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("size"))))
    return df.select("item_id", "size", _window_text(F.col("start"), F.col("size")).alias("window")).distinct()


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the item ids."""
    windows = settle(item_windows(items), "item-windows")
    lengths = sorted(r[0] for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect())
    # A window's own fingerprint: its least gram, or the hash of all its words if it is short.
    split = computed_once(windows, "w", F.split("window", " "))
    marks = computed_once(split, "g", _gram_hashes(GRAM)).select(F.when(F.size("w") == WINDOW, F.array_min("g")).alias("mark")).where("mark is not null")
    for n in lengths:
        marks = marks.unionByName(split.where(F.size("w") == n).select(_gram_hashes(n)[0].alias("mark")))
    marks = settle(marks.distinct(), "item-fingerprints")

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(text_or_empty()).alias("version"))
    worded = computed_once(rows, "w", _words())
    prints = computed_once(worded.select("doc_id", "version", "w"), "g", _gram_hashes(GRAM))
    # Words and hashes are made once a row; what is left of a row is written, for the join and for the result.
    prints = settle(prints.select("doc_id", "version", F.size("w").cast("long").alias("n_words"), F.concat(_fingerprints(), _short(lengths)).alias("marks")), "document-marks")
    found = prints.select("doc_id", "version", F.explode("marks").alias("mark")).join(marks, "mark")
    found = found.groupBy("doc_id", "version").agg(F.collect_set("mark").alias("found"))
    found = settle(found, "document-fingerprints")

    # Extend: the windows that contain a fingerprint found, compared with the items' windows.
    same = F.col("d.version").eqNullSafe(F.col("f.version")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
    hit = rows.alias("d").join(found.alias("f"), same).select("d.doc_id", "d.version", "d.text", "f.found").dropDuplicates(["doc_id", "version"])
    hit = computed_once(hit, "w", _words())
    hit = computed_once(hit.drop("text"), "g", _gram_hashes(GRAM))
    last = F.size("w") - WINDOW
    starts = F.flatten(F.transform(
        F.filter(_positions(F.size("g")), lambda p: F.array_contains(F.col("found"), F.get(F.col("g"), p))),
        lambda p: F.when(last >= 0, F.sequence(F.greatest(p - (SPAN - 1), F.lit(0)), F.least(p, last))).otherwise(F.array().cast("array<int>"))))
    size_of = lambda at, n: F.transform(at, lambda s: F.struct(s.alias("start"), F.lit(n).alias("size")))
    spans = [size_of(F.array_distinct(starts), WINDOW)]
    spans += [size_of(_short_starts(n), n) for n in lengths]
    placed = hit.select("doc_id", "version", "w", F.explode(F.concat(*spans)).alias("span"))
    placed = placed.select("doc_id", "version", "span", _window_text(F.col("span.start"), F.col("span.size")).alias("window"))
    met = placed.join(windows.select("window", "item_id"), "window").groupBy("doc_id", "version").agg(
        F.collect_set("span").alias("spans"), F.collect_set("item_id").alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))))
    met = met.select("doc_id", "version", covered.cast("long").alias("n_hit"), F.array_sort("items").alias("items"))

    counted = prints.select("doc_id", "version", "n_words")
    same = F.col("d.version").eqNullSafe(F.col("m.version")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
    items_of = F.coalesce("m.items", F.array().cast("array<string>"))
    return counted.alias("d").join(met.alias("m"), same, "left").select(
        "d.doc_id", "d.n_words", F.coalesce("m.n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), F.col("m.n_hit").isNotNull().alias("contaminated"), items_of.alias("items"))


# One row per document, as the query returns it, in DuckDB SQL. Item texts have at least ten words or are one window.
SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS gram
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS gram
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, (SELECT DISTINCT size FROM bw))),
hits AS (SELECT doc_id, s, size, item_id FROM dw JOIN bw USING (gram, size)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
met AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, items IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN met USING (doc_id)
"""
