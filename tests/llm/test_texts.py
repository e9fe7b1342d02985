from __future__ import annotations

import hashlib
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newslake.llm import decontaminate, mixing, quality_votes, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, tokens string"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, texts):
    rows = [(i, t, "en", "s", None, "k", "t") for i, t in enumerate(texts)] + [(None, "a b", None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


TEXTS = [None, "", " ", "a", "don't we'll  it's", "x" * 3000, "déjà vu ß 漢字 \U0001F600 ١٢٣", "a\n\n  b\t\tc  \n", "end<|endoftext|>of<|endoftext|><|endoftext|>",
         "   x　", "thonblent " * 900, "Ünïcödé " * 5 + "!!! ??? #$%&*<>|", " ".join(str(i) for i in range(900)), "A.B.C. " * 200]


def test_token_counts(spark):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs(spark, TEXTS), PATH).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 1024), t
    c = token_counts.counter(PATH)
    for t in TEXTS[3:9]:
        counts = c.prefix_counts(t)
        assert counts[-1] == c.total(t) and len(counts) == len(t.encode()) + 1
    for word in ("thonblent", "xxxxxxxxxxxx", "antidisestablishment", "ééàß"):  # every prefix, against plain merging
        raw = word.encode()
        assert c.row(raw) == [len(c.merge(raw[:i])) if i else 0 for i in range(len(raw) + 1)]
    long = TEXTS[10]
    cut = c.within(long, 1024)
    assert c.prefix_counts(long)[cut] <= 1024 < c.prefix_counts(long)[cut + 1] == 1025


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    at = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(at)


@pytest.mark.parametrize("bits", [24, 3])
def test_quality_votes(spark, monkeypatch, bits):
    monkeypatch.setattr(quality_votes, "POSITION_BITS", bits)
    r = random.Random(4)
    prose = lambda n, k: " ".join("".join(r.choice("abcdeé") for _ in range(k)) + r.choice(["", "", "."]) for _ in range(n))
    texts = [t for t in TEXTS if t is None or len(t) < 3000] + [prose(r.randint(1, 150), r.randint(1, 5)) for _ in range(40)]
    texts += [prose(80, 6) + "\n" + "menu | home\n" * 6, "one two three one two three one two", "a b a b a b a", prose(60, 5).replace(" ", "%%% ")]
    got = {x.doc_id: x for x in quality_votes.judge(docs(spark, texts)).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        g, m = got[i], measures(t)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == m, t
        assert g.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (g.kept and g.base_failed)
    assert quality_votes.judge(docs(spark, []).limit(0)).count() == 0


def test_votes_find_the_poor_class(spark):
    names = [f"vote_{k}" for k in quality_votes.rules()]
    good = [tuple(1 for _ in names)] * 900
    poor = [tuple(0 if k in (0, 5) else 1 for k in range(len(names)))] * 100
    accuracy, prior = quality_votes.estimate(spark.createDataFrame(good + poor, ", ".join(f"{n} int" for n in names)))
    assert 0.85 < prior < 0.95 and accuracy[names[0]][0] > 0.99


def windows(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    n = min(len(w), 10)
    return w, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_decontamination(spark):
    r = random.Random(9)
    prose = lambda n: " ".join("".join(r.choice("abcDE9ÉéK") for _ in range(r.randint(1, 5))) for _ in range(n))
    items = [(i, prose(r.randint(10, 40))) for i in range(12)] + [(100, "Short item"), (101, "one"), (102, "six words are in this item"), (103, ""), (104, None),
             (2, prose(15)), (None, prose(20))]
    texts = [None, "", "...", "one", "a one. short, ITEM one", "six words are in this ITEM!"]
    for _ in range(60):
        parts = [prose(r.randint(0, 30))]
        for _ in range(r.randint(0, 2)):
            w = r.choice(items[:12])[1].split(" ")
            a = r.randrange(len(w))
            parts += ["; ".join(w[a : a + r.randint(5, 25)]), prose(r.randint(0, 12))]
        texts.append(" ".join(parts))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {x.doc_id: x for x in decontaminate.contamination(docs(spark, texts), bench).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        w, _ = windows(t)
        hit, ids = set(), set()
        for item, text in items:
            for x in windows(text)[1] if item is not None else ():
                for s in range(len(w) - len(x) + 1):
                    if tuple(w[s : s + len(x)]) == x:
                        hit |= set(range(s, s + len(x)))
                        ids.add(str(item))
        g = got[i]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (len(w), len(hit), len(ids), bool(hit)), t
        assert g.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    assert decontaminate.contamination(docs(spark, TEXTS), bench.limit(0)).where("contaminated").count() == 0


def test_mixing(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(1, 40), r.choice(["en", "en", "de", None]), r.choice("aaaab"), None, "k", "t") for i in range(3000)]
    rows += [(9001, None, None, None, None, None, None), (9002, "", "en", "a", None, None, None), (None, "x y", "en", "a", None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.4, "de": 0.3, "": 0.3}}
    found = mixing.labelled(df)
    cells = found.where("tokens > 0").groupBy(*mixing.DIMENSIONS).sum("tokens").withColumnRenamed("sum(tokens)", "tokens")
    raked = mixing.rake(cells, {d: mixing._targets(cells, d, targets.get(d)) for d in mixing.DIMENSIONS}).collect()
    for label, share in targets["lang"].items():
        assert abs(sum(x.weight for x in raked if x.lang == label) - share) < 1e-4
    assert max(x[m] for x in raked for m in mixing.MISSES) < 1e-5
    got = mixing.mix(df, targets, budget=0.2).collect()
    assert len(got) == len(rows)
    total, chosen = sum(g.tokens for g in got), sum(g.tokens for g in got if g.taken)
    assert abs(sum(g.tokens * g.probability for g in got) / total - 0.2) < 1e-3 and abs(chosen / total - 0.2) < 0.03
    assert not any(g.taken for g in got if g.doc_id in (9001, 9002))
    kept = {r.doc_id for r in mixing.sampled(df, targets, budget=0.2).collect()}
    assert kept == {g.doc_id for g in got if g.taken}
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_reports_targets_that_cells_cannot_meet(spark):
    """c is found in fr only, with other targets: raking ends, and the misses are those of the returned weights."""
    cells = spark.createDataFrame([("a", "en", "prose", 100), ("a", "de", "prose", 50), ("b", "de", "prose", 30), ("c", "fr", "prose", 20)], "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.1, "de": 0.5, "fr": 0.4}}
    wanted = {d: mixing._targets(cells, d, targets.get(d)) for d in mixing.DIMENSIONS}
    got = mixing.rake(cells, wanted).collect()
    for d, shares in (targets | {"topic": {"prose": 1.0}}).items():
        for label, share in shares.items():
            now = sum(r.weight for r in got if r[d] == label)
            assert all(abs(r[f"miss_{d}"] - abs(now / share - 1)) < 1e-9 for r in got if r[d] == label)
    assert max(r.miss_topic for r in got) < 1e-9 and max(r.miss_source for r in got) > 0.2


def test_votes_are_weighed_as_a_plain_version_does(spark):
    """Expectation-maximisation in plain Python from the shares of good votes: same rates, posterior by posterior."""
    names = [f"vote_{k}" for k in quality_votes.rules()]
    rng = random.Random(11)
    rows = []
    for _ in range(800):
        truth = rng.random() < 0.8
        rows.append(tuple(None if rng.random() < 0.3 else int(truth if rng.random() < 0.75 + 0.03 * j else not truth) for j in range(len(names))))
    rows += [(None,) * len(names)] * 5
    accuracy, prior, steps = quality_votes.fitted(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)))
    cast = [r for r in rows if any(v is not None for v in r)]
    good = [sum(v or 0 for v in r) / sum(v is not None for v in r) for r in cast]
    rates, share, n, moved = [(0.5, 0.5)] * len(names), 0.5, 0, 1.0
    while moved > quality_votes.CLOSE:
        if n:
            good = []
            for r in cast:
                up, down = share, 1 - share
                for v, (g, b) in zip(r, rates):
                    if v is not None:
                        up, down = up * (g if v else 1 - g), down * (1 - b if v else b)
                good.append(up / (up + down))
        new = []
        for j in range(len(names)):
            seen = [(r[j], q) for r, q in zip(cast, good) if r[j] is not None]
            new.append(((sum(q for v, q in seen if v) + 1) / (sum(q for _, q in seen) + 2),
                        (sum(1 - q for v, q in seen if not v) + 1) / (sum(1 - q for _, q in seen) + 2)))
        now = (sum(good) + 1) / (len(cast) + 2)
        moved = max(abs(now - share), *(abs(x - y) for a, b in zip(new, rates) for x, y in zip(a, b)))
        rates, share, n = new, now, n + 1
    assert n == steps and abs(prior - share) < 1e-9
    assert all(abs(x - y) < 1e-9 for name, wanted in zip(names, rates) for x, y in zip(accuracy[name], wanted))


def test_no_document_passes_the_base_rules(spark):
    rows = quality_votes.judge(docs(spark, ["too short", None, ""])).collect()
    assert all(r.base_failed and not r.kept and r.posterior == 0.5 and r.steps == 0 for r in rows)
