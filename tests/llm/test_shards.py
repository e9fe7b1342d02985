from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from newslake.llm import quality_mil, shards, toxicity
from newslake.llm.textbytes import runs

DOCS = "doc_id long, text string, lang string"
ROWS = 60


class Counting:
    """Moves one parameter by the number of texts, another by their bytes, and the first shard's alone."""

    def __init__(self, state, seed):
        self.p, self.first = state, seed % 1000 == 0

    def add(self, texts, labels):
        self.p["texts"] += len(texts) + 10 * labels.sum()
        if self.first:
            self.p["rare"] += 1

    def state(self):
        return self.p


def test_every_labelled_row_is_in_a_shard(spark, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_ROWS", 20)
    texts = {i: "x" * i for i in range(ROWS)}
    texts[7] = "y" * 40_000  # longer than a sample's texts
    docs = spark.createDataFrame([*((i, t, "en") for i, t in texts.items()), (3, None, "en"), (None, "z", "en"), (900, "z", "en")], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(ROWS)] + [(901, 1)], "doc_id long, kind int")
    rows = shards.labelled_shards(docs, labels, "kind")
    got = rows.collect()
    assert sorted((g.doc_id, g.label, g.size) for g in got) == sorted([*((i, i % 2, len(t)) for i, t in texts.items()), (3, 1, 0)])
    assert len({g.shard for g in got}) > 1
    assert shards.labelled_shards(docs.limit(0), labels, "kind").count() == 0


def test_rounds_average_over_the_shards_that_moved(spark, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_ROWS", 20)
    docs = spark.createDataFrame([(i, "t", "en") for i in range(ROWS)], DOCS)
    rows = shards.labelled_shards(docs, spark.createDataFrame([(i, 0) for i in range(ROWS)], "doc_id long, kind int"), "kind")
    sizes = [r["count"] for r in rows.groupBy("shard").count().collect()]
    got = shards.learn(rows, {"texts": np.zeros((2, 1), np.float32), "rare": np.zeros(1, np.float32), "still": np.ones(3, np.float32)}, Counting, 2)
    assert got["texts"] == pytest.approx(2 * sum(n * n for n in sizes) / sum(sizes))
    assert got["rare"].tolist() == [2] and got["still"].tolist() == [1, 1, 1]


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality_mil, "quality")])
def test_models_learn_from_rows_beyond_a_sample(spark, monkeypatch, module, label):
    """No sample is drawn, and each labelled text reaches a learner, or the thresholds."""
    seen = spark.sparkContext.accumulator(0)
    add, rows = module.Learner.add, 3600
    docs = spark.createDataFrame([(i, f"word{i % 7} {'scum %%%' if i % 2 else 'fine day'}", "en") for i in range(rows)], DOCS).repartition(2)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(rows)], "doc_id long, quality int, toxic int")

    def counted(self, texts, labels):
        seen.add(len(texts))
        add(self, texts, labels)

    monkeypatch.setattr(module, "ROUNDS", 1)
    learn = shards.learn

    def spied(rows, state, learner, rounds):
        def made(state, seed):
            out = learner(state, seed)
            out.add = counted.__get__(out)
            return out

        return learn(rows, state, made, rounds)

    monkeypatch.setattr(shards, "learn", spied)
    assert (module.fit(docs, labels, None) if module is toxicity else module.fit(docs, labels)) is not None
    least = labels.where(f"crc32(cast(cast(doc_id as string) as binary)) % {module.FOLDS} <> {module.HELD_OUT}").count()
    assert seen.value == (least if module is quality_mil else least - _tuned(labels, module))


def _tuned(labels, module):
    return labels.where(f"crc32(cast(cast(doc_id as string) as binary)) % {module.FOLDS} <> {module.HELD_OUT} and pmod(xxhash64(doc_id), 4) = 3").count()


def test_winning_windows_are_the_first_maxima():
    model = toxicity.ConvModel()
    codes, base = toxicity.word_codes(next(runs(pa.array(["a b a b a", "", "long " * 70_000 + "end", "c"]))))
    won = np.zeros((4, toxicity.FILTERS * len(toxicity.WIDTHS)), np.int64)
    pooled = model.pooled(codes, base, won)
    for d in range(4):
        e = model.embed(codes[base[d] : base[d + 1]])
        n = len(e) - max(toxicity.WIDTHS) + 1
        for i, w in enumerate(toxicity.WIDTHS):
            part = slice(i * toxicity.FILTERS, (i + 1) * toxicity.FILTERS)
            value = np.hstack([e[k : k + n] for k in range(w)]) @ model.filters[i] + model.shift[i]
            best = np.maximum(value.max(axis=0), 0)
            assert np.allclose(pooled[d, part], best, atol=1e-4)
            at = won[d, part] - base[d]
            assert all(abs(value[at[f], f] - best[f]) < 1e-4 for f in range(toxicity.FILTERS) if best[f] > 1e-3)
