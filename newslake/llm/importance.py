"""Importance resampling towards a target distribution over hashed n-grams.

Features are all runs of 1 to ``longest`` consecutive words of a whole text, repeats counted. Each falls into a bucket (CRC32 of its
bytes). A bucket's gain is the scaled log ratio of its smoothed share among the target texts and among the documents; a
document's weight is the floored mean gain of its features. A Gumbel draw from the document's id is added, and the highest
scores among documents of ``LEAST_WORDS`` words or more are drawn: sampling without replacement by weight that a rerun repeats.

Within a task, the n-grams of a part of the texts are interned in an open-addressed NumPy table: the xxhash64 of the bytes gives
the first slot and the key, probing is linear, and a slot is shared only after the bytes themselves compared equal. A
slot stores the bucket and the count of its n-gram, so that each distinct n-gram is hashed to its bucket once; every occurrence keeps
its slot id and gathers its gain through it. Tasks add up ``buckets`` numbers each and the driver sees as many, whatever the input's size.

Null text has no words; a text without words has weight 0. A null id draws as the empty text. Rows that repeat an id are rows of
their own (same draw, ties in any order). Long texts are interned part by part. An empty table of documents gives an empty
result; without target texts all gains follow from the documents alone. Other columns of the inputs are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import free_memory, map_batches
from newslake.operators.position import numbered
from newslake.session import settle

LONGEST = 1
BUCKETS = 10_000
SCALE = 1000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
PART_BYTES = 1 << 22  # a longer text is cut between words
PART_GRAMS = 1 << 17
# Bytes of words keep their place, A-Z in lower case; all others separate.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Interned:
    """Slot of each occurrence, and per slot the bucket and the count of the n-gram it holds."""

    slot: np.ndarray
    bucket: np.ndarray
    count: np.ndarray


def intern(grams: list[bytes], buckets: int) -> Interned:
    """Table of the distinct n-grams, at most half full."""
    n = len(grams)
    size = 1 << max(4, (2 * n).bit_length())
    last = size - 1
    keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, n)
    texts = np.empty(n, object)
    texts[:] = grams
    holder = np.full(size, -1, np.int64)  # the occurrence whose key and bytes a slot holds
    slot = np.empty(n, np.int64)
    waiting, at = np.arange(n), (keys & np.uint64(last)).astype(np.int64)
    while len(waiting):
        free = holder[at] < 0
        holder[at[free]] = waiting[free]  # of several claims to a slot one stands; equal n-grams always probe together
        owner = holder[at]
        same = keys[owner] == keys[waiting]
        same[same] = (texts[owner[same]] == texts[waiting[same]]).astype(bool)
        slot[waiting[same]] = at[same]
        waiting, at = waiting[~same], (at[~same] + 1) & last
    bucket = np.zeros(size, np.int64)
    used = np.flatnonzero(holder >= 0)
    bucket[used] = [crc32(g) % buckets for g in texts[holder[used]]]
    return Interned(slot, bucket, np.bincount(slot, minlength=size))


def _word_parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, long texts in several lists."""
    first = 0
    while len(text) - first > PART_BYTES:
        cut = first + PART_BYTES
        plain = text[first:cut].translate(WORD_BYTES)
        space = plain.rfind(b" ")
        if space < 0:  # one word longer than a part: go on to its end
            tail = text[cut:].translate(WORD_BYTES).find(b" ")
            cut = len(text) if tail < 0 else cut + tail
        else:
            cut = first + space
        yield text[first:cut].translate(WORD_BYTES).split()
        first = cut
    yield text[first:].translate(WORD_BYTES).split()


def occurrences(column: pa.Array, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Parts of a column of texts: rows, how many n-grams of each row follow one another, and the n-grams."""
    rows, sizes, grams = [], [], []
    for row, text in enumerate(column.cast(pa.large_binary()).to_pylist()):
        before: list[bytes] = []
        for words in _word_parts(text or b""):
            start = len(grams)
            grams += words
            words = before + words
            for n in range(2, longest + 1):
                grams += [b" ".join(words[i : i + n]) for i in range(max(len(before) - n + 1, 0), len(words) - n + 1)]
            before = words[len(words) - longest + 1 :] if longest > 1 else []
            rows.append(row)
            sizes.append(len(grams) - start)
            if len(grams) >= PART_GRAMS:
                yield np.array(rows), np.array(sizes), grams
                rows, sizes, grams = [], [], []
    if grams:
        yield np.array(rows), np.array(sizes), grams


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; each task adds up its texts first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, grams in occurrences(batch.column(0), longest):
                table = intern(grams, buckets)
                total += np.bincount(table.bucket, weights=table.count, minlength=buckets).astype(np.int64)
        free_memory()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket long, n long")
    return sums.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket; what reaches the driver is two numbers a bucket."""
    sides = [bucket_counts(t, longest, buckets).withColumn("side", F.lit(k)) for k, t in enumerate((docs, target))]
    counts = np.zeros((2, buckets), np.int64)
    for r in sides[0].unionByName(sides[1]).collect():
        counts[r.side, r.bucket] = r.n
    all_docs, all_target = (float(int(c.sum()) + buckets) for c in counts)
    return np.array([math.floor(SCALE * math.log(float(t + 1) * all_docs / (float(s + 1) * all_target))) for s, t in counts.T.tolist()], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """Per row: doc_id, n_words, n_features and weight."""

    def weigh(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        features, sums = np.zeros((2, batch.num_rows), np.int64)
        for rows, sizes, grams in occurrences(batch.column("text"), longest):
            table = intern(grams, len(gain))
            running = np.concatenate([[0], np.cumsum(gain[table.bucket][table.slot])])
            ends = np.cumsum(sizes)
            np.add.at(sums, rows, running[ends] - running[ends - sizes])
            np.add.at(features, rows, sizes)
        words = features if longest == 1 else np.array([sum(map(len, _word_parts(t or b""))) for t in batch.column("text").cast(pa.large_binary()).to_pylist()], np.int64)
        weight = sums // np.maximum(features, 1)
        return [pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank among the drawn (else null) and n_words.

    The order of the draw is found by range partitioning, so no task sorts more than its range.
    """
    rows = weighed(docs, gains(docs, target, longest, buckets), longest)
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(F.lit(-float(SCALE)) * F.log(-F.log(uniform)))
    scored = settle(rows.withColumn("score", score.cast("long")), "scored")
    able = F.col("n_words") >= LEAST_WORDS
    drawn = scored.where(able).count() * percent // 100
    order = scored.withColumns({"_short": ~able, "_low": -F.col("score")})
    placed = numbered(order, [], ["_short", "_low", "doc_id"], "_place")
    rank = F.when(~F.col("_short") & (F.col("_place") <= drawn), F.col("_place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"), "n_words")


SQL = """
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 'b', 0, NULL, text FROM benchmark),
listed AS (
  SELECT side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
words AS (SELECT side, row, word, count(*) AS n FROM (SELECT side, row, unnest(words) AS word FROM listed) GROUP BY ALL),
coded AS (SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM words)),
bucketed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(code) // 2), lambda i: CAST('0x' || substr(code, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
         lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket FROM coded, steps),
counts AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM words JOIN bucketed USING (word) GROUP BY bucket),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(c.t + 1 AS DOUBLE) * (a.s + 10000) / (CAST(c.s + 1 AS DOUBLE) * (a.t + 10000)))) AS BIGINT) AS gain
  FROM counts c, totals a),
sums AS (SELECT row, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS gain FROM words JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (
  SELECT l.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
         CAST(coalesce((gain - ((gain % n) + n) % n) // n, 0) AS BIGINT) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(l.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS draw
  FROM listed l LEFT JOIN sums USING (row) WHERE side = 'd'),
placed AS (
  SELECT doc_id, n_features, weight, weight + draw AS score,
         row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + draw DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN place END AS rank, n_features AS n_words
FROM placed
"""
