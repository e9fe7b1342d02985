from __future__ import annotations

import corpus_pipeline
from newslake.llm import near_dedup
from newslake.llm.common import has_bit, id_bits, id_place
from newslake.session import settle


def test_bits_of_ids(spark):
    wanted = {0, 5, -7, 2**40, 77}
    bits = id_bits(spark.createDataFrame([(i,) for i in [*wanted, 5]], "doc_id long")).value
    probe = spark.createDataFrame([(i,) for i in [*wanted, *range(100, 2000)]], "doc_id long").select("doc_id", id_place().alias("place")).toArrow()
    flags = dict(zip(probe.column("doc_id").to_pylist(), has_bit(bits, probe.column("place").combine_chunks()).to_pylist(), strict=True))
    assert all(flags[i] for i in wanted) and sum(flags.values()) < len(wanted) + 5
    assert not id_bits(spark.createDataFrame([], "doc_id long")).value.any()


def test_only_wanted_texts_travel(spark):
    docs = spark.createDataFrame([(i, f"one two three four {i}") for i in range(500)] + [(None, "x"), (3, None)], "doc_id long, text string")
    ids = spark.createDataFrame([(3,), (44,), (900,)], "doc_id long")
    packed = near_dedup.map_batches(docs.select("doc_id", id_place().alias("place"), near_dedup.text_or_empty().alias("text")),
                                    near_dedup._pack(id_bits(ids)), near_dedup.PACKED)
    assert 3 <= packed.count() < 10
    assert sorted(r.doc_id for r in near_dedup._member_sets(ids, docs).collect()) == [3, 3, 44]


def test_without_keeps_rows_without_an_id(spark):
    docs = spark.createDataFrame([(i % 50 if i else None, f"t{i}") for i in range(100)], "doc_id long, text string")
    gone = settle(spark.createDataFrame([(7,), (8,), (1000,)], "doc_id long"), "gone")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline._without(docs, gone).collect()), key=str)
    assert got == sorted(((i % 50 if i else None, f"t{i}") for i in range(100) if i == 0 or i % 50 not in (7, 8)), key=str)
