"""Every row takes part in learning, and as often in a large table as in a small one."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from newslake.llm import language, shards, toxicity
from newslake.llm.textbytes import runs

DOCS = "doc_id long, text string, lang string"
HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"


def spied(monkeypatch, watch):
    """``watch(learner)`` sees each learner before it learns."""
    learn = shards.learn

    def spy(rows, state, learner, rounds, *read):
        def made(state, seed):
            out = learner(state, seed)
            watch(out)
            return out

        return learn(rows, state, made, rounds, *read)

    monkeypatch.setattr(shards, "learn", spy)


@pytest.mark.parametrize("shard_rows", [100, 1 << 15])
def test_toxicity_goes_as_often_through_many_rows_as_through_few(spark, monkeypatch, shard_rows):
    seen = spark.sparkContext.accumulator(0)

    def watch(learner):
        step = learner.model.step

        def counted(codes, base, y, weight, adam):
            seen.add(len(y))
            step(codes, base, y, weight, adam)

        learner.model.step = counted

    spied(monkeypatch, watch)
    monkeypatch.setattr(shards, "SHARD_ROWS", shard_rows)
    docs = spark.createDataFrame([(i, f"word{i % 7} {'scum' if i % 2 else 'fine day'}", "en") for i in range(400)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels, None) is not None
    taught = labels.where(f"not {HELD_OUT} and pmod(xxhash64(doc_id), 4) <> 3").count()
    assert seen.value == taught * 2 * toxicity.ROUNDS


def prose(letters, r, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.mark.parametrize("shard_rows, least", [(1 << 15, 400), (300, 100)])
def test_languages_are_learned_from_every_row(spark, monkeypatch, shard_rows, least):
    r = random.Random(3)
    rows = [(i, prose("theandrsio", r, 30), "en") for i in range(1500)]
    rows += [(i, prose("schungeitz", r, 30), "de") for i in range(1500, 1540)]
    rows += [(i, prose("кошвдьа", r, 30), "uk") for i in range(1540, 1900)]
    rows += [(5, prose("theandrsio", r, 30), "en"), (None, "a", "en"), (6, "a", None), (7, None, "en"), (1900, "", "en"), (1901, prose("schungeitz", r, 200) * 300, "de")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    known = docs.where(f"doc_id is not null and text is not null and lang is not null and not {HELD_OUT}")
    counts = dict(known.groupBy("lang").count().collect())
    seen = spark.sparkContext.accumulator(0)

    def watch(learner):
        add = learner.add

        def counted(shares, labels):
            seen.add(len(labels))
            add(shares, labels)

        learner.add = counted

    spied(monkeypatch, watch)
    monkeypatch.setattr(shards, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(language, "LEAST", least)
    model = language.fit(docs)
    n = -(-sum(counts.values()) // shard_rows)
    assert seen.value == language.ROUNDS * sum(c * min(n, -(-least * n // c)) for c in counts.values())
    got = language.identify(docs, model).collect()
    truth = {i: lang for i, text, lang in rows if i is not None and text and lang}
    wrong = [g.doc_id for g in got if g.doc_id in truth and g.lang_pred != truth[g.doc_id]]
    assert len(wrong) <= 0.01 * len(truth)
    assert not [i for i in wrong if truth[i] == "de"]


def test_shares_come_back_as_they_were_counted():
    r = random.Random(1)
    texts = ["", "a", "abc", None, "x" * 100_000, "é" * 5000, "ab" * 40_000 + prose("qwertzuiop", r, 500)]
    texts += ["".join(chr(r.choice([r.randrange(97, 123), 32, r.randrange(200, 9000)])) for _ in range(r.randrange(3000))) for _ in range(60)]
    names, ids = ["a", "b"], np.arange(len(texts))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids % 3), pa.array(ids), pa.array(ids), pa.array([names[i % 2] for i in ids]), pa.array(texts)], ["base", "place", "doc_id", "lang", "text"])
    (dealt,) = language._dealer(names, [1, 3], 3)(batch)
    found = list(zip(dealt.column("doc_id").to_pylist(), dealt.column("shard").to_pylist(), language.shares_of(dealt), strict=True))
    assert sorted((i, s) for i, s, _ in found) == sorted((i, s) for i in ids for s in ([i % 3] if i % 2 == 0 else range(3)))
    for i, _, row in found:
        key, first, end = language.trigrams(next(runs(pa.array([texts[i]], pa.string()))))
        number = np.bincount(key[first[0] : end[0]], minlength=language.BUCKETS)
        assert np.allclose(row, number / max(number.sum(), 1), atol=1e-7)
