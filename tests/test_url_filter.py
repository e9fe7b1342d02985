"""The filter of stored URLs: no stored one missed, few others suspected, and what a batch reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.operators import dedup, url_filter, vectors
from newslake.session import scratch_path
from tests.test_vectors import points


def bucket():
    return F.pmod(F.xxhash64("url"), F.lit(8))


def _urls(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("https://n.example/"), F.col("id")).alias("url"))


def test_no_stored_url_is_missed_and_few_others_are_suspected(spark):
    stored = _urls(spark, 0, 8000)
    made = url_filter.url_filter(stored, bucket(), words=250)  # four URLs a word
    assert made.count() <= 8 * 250
    halves = [url_filter.url_filter(_urls(spark, a, a + 4000), bucket(), words=250) for a in (0, 4000)]
    parts = url_filter.merged(halves[0].unionByName(halves[1]))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, made.collect()))
    asked = url_filter.keyed(_urls(spark, 0, 28000), bucket(), words=250)
    found = {r.url for r in url_filter.suspects(asked, halves[0].unionByName(halves[1])).collect()}
    assert {r.url for r in stored.collect()} <= found
    assert len(found) - 8000 < 20000 * 0.01


def test_the_result_is_the_exact_one(spark):
    stored = _urls(spark, 0, 500).unionByName(spark.createDataFrame([("",), (None,)], "url string"))
    rows = [(i, f"https://n.example/{i % 700}") for i in range(2000)] + [(-1, None), (-2, ""), (-3, None)]
    articles = spark.createDataFrame(rows, "n long, url string")
    for words in (url_filter.WORDS, 3):  # with three words nearly all are suspects
        got = url_filter.not_stored_filtered(articles, stored, url_filter.url_filter(stored, bucket(), words), bucket(), words)
        assert sorted(r.n for r in got.collect()) == sorted(r.n for r in dedup.not_stored(articles, stored).collect())
    nothing = stored.limit(0)
    assert url_filter.not_stored_filtered(articles, nothing, url_filter.url_filter(nothing, bucket()), bucket()).count() == len(rows)
    assert url_filter.not_stored_filtered(articles.limit(0), stored, url_filter.url_filter(stored, bucket()), bucket()).count() == 0


def test_a_batch_of_new_urls_reads_no_bucket(spark):
    root = scratch_path(spark, "filtered")
    asked = points(spark, ("u1", "a"), ("new", "b"), ("", "c"))
    assert vectors.stored_among(spark, root, asked).count() == 0
    vectors.upsert(points(spark, *[(f"u{i}", "t") for i in range(60)], ("", "no url")), root, 0, "batch")
    vectors.upsert(points(spark, ("u1", "again"), ("s1", "t")), root, 0, "stream")
    found = vectors.stored_among(spark, root, asked)
    assert {r.url for r in found.collect()} == {"u1"}
    folders = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}
    assert len(folders) == 1
    fresh = vectors.stored_among(spark, root, points(spark, *[(f"x{i}", "t") for i in range(20)]))
    assert fresh.count() == 0 and not [f for f in fresh.inputFiles() if "bucket=" in f]
    assert vectors.stored_among(spark, root, points(spark, ("s1", "t")), ("stream", 0)).count() == 0
    vectors.compact(spark, root)
    assert {r.url for r in vectors.stored_among(spark, root, asked).collect()} == {"u1"}
