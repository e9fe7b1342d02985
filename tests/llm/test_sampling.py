from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from newslake.llm import sampling


def smallest(rows, n):
    """The n rows of smallest hash of each stratum, by a plain sort."""
    out = set()
    for s in {r.s for r in rows}:
        out |= {(r.doc_id, s) for r in sorted((r for r in rows if r.s == s), key=lambda r: (r.h, r.doc_id))[:n]}
    return out


@pytest.mark.parametrize("wanted", [1, 30, 5000])
def test_stratified_is_the_smallest_hashes(spark, wanted):
    stratum = F.expr("CASE WHEN id % 10 < 8 THEN 'hot' WHEN id % 10 = 8 THEN 'rare' WHEN id % 100 < 50 THEN NULL ELSE concat('s', id) END")
    rows = spark.range(0, 6000).select((F.col("id") * 7).alias("doc_id"), stratum.alias("s"))
    got = sampling.stratified(rows, F.col("s"), wanted)
    assert got.columns == ["doc_id", "s"]
    assert {tuple(r) for r in got.collect()} == smallest(rows.withColumn("h", F.xxhash64("doc_id")).collect(), wanted)
    assert sampling.stratified(rows.limit(0), F.col("s"), wanted).count() == 0


def test_labelled_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sampling, "LONGEST", 100)
    monkeypatch.setattr(sampling, "LABEL_BYTES", 1000)
    docs = [(i, "x" * (i % 90)) for i in range(300)] + [(500, "y" * 101), (501, "é" * 60), (502, None), (503, "a"), (503, "b"), (None, "z"), (900, "no label")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("label", F.lit("clash")).withColumn("size", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(i, 7) for i in range(500, 505)], "doc_id long, kind int")
    got = sampling.labelled_texts(docs, labels, "kind", 40).collect()
    assert {(r.doc_id, r.text) for r in got if r.label == 7} == {(502, ""), (503, "b")}
    hashes = {r.doc_id: r.h for r in labels.withColumn("h", F.xxhash64("doc_id")).collect()}
    for label in (0, 1):
        taken, total = set(), 0
        for i in sorted(range(label, 300, 2), key=hashes.get)[:40]:
            total += i % 90
            if total <= 1000:
                taken.add(i)
        assert {r.doc_id for r in got if r.label == label} == taken
    assert sampling.labelled_texts(docs.limit(0), labels, "kind", 40).count() == 0
