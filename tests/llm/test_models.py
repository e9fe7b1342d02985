from __future__ import annotations

import random
import zlib

import pytest

from newslake.llm import language, quality_mil, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string"
LABELS = "doc_id long, quality int, toxic int"
LETTERS = {"en": "theandrsio", "de": "schungeitz", "fr": "eauxonleqi", "es": "cionllajar"}


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(11)
    docs, labels = [], []
    for i in range(360):
        lang = r.choice(list(LETTERS))
        ws = ["".join(r.choice(LETTERS[lang]) for _ in range(r.randint(2, 7))) for _ in range(r.randint(40, 200))]
        poor, toxic = r.random() < 0.3, r.random() < 0.35
        if poor:
            ws = [w + r.choice(["%%%", "&&&", "$$$"]) for w in ws]
        if toxic:
            for _ in range(3):
                ws.insert(r.randrange(len(ws)), r.choice(["idiot", "moron", "scum"]))
        docs.append((i, " ".join(ws), lang, "s", 1, 0.5, "x"))
        labels += [(i, int(not poor), int(toxic))] * (1 + i % 2)
    docs += [(1000, None, "en", None, None, None, None), (1001, "", None, None, None, None, None), (1002, "12 34 !", "de", None, None, None, None),
             (None, "theand rsio", None, None, None, None, None), (5, docs[5][1], docs[5][2], "s", 1, 0.1, "x"), (1003, "scum " * 50_000, None, None, None, None, None)]
    labels += [(2000, 1, 1), (None, 0, 0), (7, None, None)]
    return spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)


def fold_of(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def test_language(tables):
    docs, _ = tables
    got = language.identify(docs, language.fit(docs)).collect()
    assert len(got) == docs.count()
    assert all(g.held_out == (fold_of(g.doc_id, 4) == 2) and 0 <= g.score <= 1 for g in got)
    pred = {g.doc_id: g.lang_pred for g in got}
    assert pred[1000] == pred[1001] == pred[1002] == "und" and pred[None] == "en"
    known = {d.doc_id: d.lang for d in docs.collect() if d.doc_id is not None and d.doc_id < 1000}
    held = [i for i in known if fold_of(i, 4) == 2]
    assert sum(pred[i] == known[i] for i in held) >= 0.97 * len(held)


@pytest.mark.parametrize("module, folds, out, label, cut", [(quality_mil, 3, 1, "quality", 0.5), (toxicity, 4, 2, "toxic", 0.3)])
def test_held_out_accuracy(tables, module, folds, out, label, cut):
    docs, labels = tables
    model = module.fit(docs, labels) if module is quality_mil else module.fit(docs, labels, language.fit(docs))
    got = module.score(docs, model).collect()
    assert len(got) == docs.count()
    truth = {x.doc_id: x[label] for x in labels.collect() if x[label] is not None}
    assert all(g.held_out == (fold_of(g.doc_id, folds) == out) and 0 <= g.score <= 1 and g.predicted == (g.score >= cut) for g in got)
    held = [g for g in got if g.held_out and g.doc_id in truth]
    assert sum(g.predicted == truth[g.doc_id] for g in held) >= 0.9 * len(held)
    assert len({g.score for g in got if g.doc_id == 5}) == 1


def test_nothing_to_learn_from(spark, tables):
    docs, labels = tables
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality_mil.score(docs, quality_mil.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none, None)).collect()} == {0.0}
    empty = spark.createDataFrame([], DOCS)
    assert language.fit(empty) is None and language.identify(empty, None).count() == 0
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
