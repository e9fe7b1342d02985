from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import xxhash

import corpus_pipeline as p
from newslake.llm import language, mixing
from newslake.session import settle

SF = "/root/testdata/sf0.001"
ROWS = [(1, None, "en", "s", 1, "x"), (2, "", "en", "s", 1, "x"), (None, "the and of with", None, None, None, "x"), (3, "the and of with", "en", "s", 15, "x"),
        (3, "the and of with", "en", "s", 15, "x"), (4, "the and of with", "en", "s", 15, "x")]


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    full = {r.doc_id: r for r in docs.collect()}
    before = set(full)
    for name, stage in p.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.columns[:5] == p.COLUMNS and (name == "mixing" or docs.columns == p.COLUMNS)
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        assert after <= before and len(rows) == len(after)
        assert all(r.n_chars == len(r.text) for r in rows)
        before = after
        docs = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in p.run(spark, SF).collect()} == after


def test_odd_rows_pass_every_stage(spark):
    odd = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    for name, stage in p.STAGES:
        stage(spark, odd, SF).collect()
        stage(spark, odd.limit(0), SF).collect()
    kept = p.near_dedup_stage(spark, odd, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "None"]
    assert {r.doc_id for r in p.language_stage(spark, odd, SF).collect()} == {None, 3, 4}


def test_language_stage_without_any_label(spark):
    """With nothing to learn from, only texts without a letter go."""
    rows = [(1, "the and of with", None, "s", 15), (2, "12 + 7", None, "s", 6), (3, None, None, "s", None), (None, "é", None, None, 1), (4, "да", None, "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = p.language_stage(spark, docs, SF)
    assert kept.columns == p.COLUMNS
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "the and of with", None: "é", 4: "да"}


# --- Plain versions of the five stages' decisions, over dictionaries of doc_id: (text, lang, source) ---


def blank_words(text, low=False):
    text = "".join(chr(ord(c) + 32) if low and "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_near(docs):
    sets = {}
    for i, (text, *_) in docs.items():
        w = blank_words(text, True)
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(len(w) - 3, 1))} if w else set()
    head = {i: i for i in docs}

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in combinations(sorted(docs), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            head[y] = x
    return {i: d for i, d in docs.items() if top(i) == i}


def plain_repeats(docs):
    seen, out = set(), {}
    for i in sorted(docs):
        raw = (docs[i][0] or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(raw[k : k + 100])
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        if left or not raw:
            out[i] = (left.decode("utf-8", "ignore"), *docs[i][1:])
    return out


def plain_leaks(docs, items):
    def word_list(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def windows(words, n):
        return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}

    wanted = [w for t in items if (w := word_list(t))]
    return {i: d for i, d in docs.items() if not any(windows(w, min(len(w), 10)) & windows(word_list(d[0]), min(len(w), 10)) for w in wanted)}


def plain_topic(text):
    shares = [sum(c in chars for c in text) / max(len(text), 1) for chars in ("#*$%&|<>{}[]=_", "0123456789", "\n")]
    return next((t for t, s, limit in zip(mixing.TOPICS, shares, mixing.LIMITS, strict=False) if s > limit), "prose")


def plain_mix(docs):
    """Raking and budget over a dictionary of cells."""
    rows = {i: ((source or "", lang or "", plain_topic(text or "")), len(blank_words(text))) for i, (text, lang, source) in docs.items()}
    tokens = Counter()
    for cell, n in rows.values():
        if n:
            tokens[cell] += n
    total = sum(tokens.values())
    weight = {c: float(n) for c, n in tokens.items()}
    targets = []
    for k, d in enumerate(mixing.DIMENSIONS):
        sums = Counter()
        for c, n in tokens.items():
            sums[c[k]] += n
        powers = {x: n ** mixing.TEMPERATURE[d] for x, n in sums.items()}
        targets.append({x: p / sum(powers.values()) for x, p in powers.items()})
    for _ in range(2000):
        for k, target in enumerate(targets):
            sums = Counter()
            for c, w in weight.items():
                sums[c[k]] += w
            weight = {c: w * target[c[k]] / sums[c[k]] for c, w in weight.items()}
    rate, scale = {c: weight[c] / tokens[c] for c in tokens}, 0.0
    for _ in range(len(rate) + 1):  # cells at probability one hand their share on
        full = [c for c in rate if rate[c] * scale >= 1]
        rest = sum(weight[c] for c in rate if c not in full)
        scale = max(scale, (mixing.BUDGET * total - sum(tokens[c] for c in full)) / rest if rest else scale)
    chance = {i: min(rate[c] * scale, 1.0) if n else 0.0 for i, (c, n) in rows.items()}
    first = xxhash.xxh64_intdigest(mixing.SEED.to_bytes(4, "little"), 42)
    draw = {i: (xxhash.xxh64_intdigest(i.to_bytes(8, "little"), first) & ((1 << 53) - 1)) / (1 << 53) for i in docs}
    return {i: d for i, d in docs.items() if draw[i] < chance[i]}


def test_every_stage_against_a_plain_version(spark, tmp_path):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeghilmnorstu") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    known = {"en": "the and of with that", "de": "der und die das nicht", "fr": "le et les des dans", "es": "el y los las que"}
    spoken = lambda lang, n: " ".join(r.choice([word(), *known[lang].split()]) for _ in range(n))
    items, shared = [prose(25), prose(14), "short item here"], prose(40)
    rows = []
    for i in range(160):
        lang = r.choice(list(known))
        text = spoken(lang, r.choice([8, 60, 150]))
        if i % 9 == 0 and rows:  # a copy, sometimes with a word changed
            text = rows[-1][1].replace(" ", r.choice([" ", " x "]), 1) if rows[-1][1] else text
        if i % 7 == 0:
            text += "\n" + shared + "\n" + spoken(lang, 20)
        if i % 13 == 0:
            text += " " + items[i % 3].upper() + " " + spoken(lang, 5)
        if i % 17 == 0:
            text = r.choice([None, "", "12 34 !!", "### $$$ " * 9 + text, text + " 123456" * 30])
        rows.append((i, text, None if i % 6 == 0 else lang, r.choice(["web", "web", "web", "book", None]), len(text or ""), "extra"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _chars string")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expected = {x[0]: (x[1], x[2], x[3]) for x in rows}
    guessed = {x.doc_id: x for x in language.labelled(docs, language.fit(docs)).collect()}
    letters = re.compile(r"[^\W\d_]")
    plain = {
        "language": lambda d: {i: (t, lang or guessed[i].lang_pred, s) for i, (t, lang, s) in d.items() if letters.search(t or "") and guessed[i].score >= p.LEAST_SCORE},
        "near_dedup": plain_near, "suffix_dedup": plain_repeats, "decontaminate": lambda d: plain_leaks(d, items), "mixing": plain_mix,
    }
    sizes = []
    for name, stage in p.STAGES:
        expected = plain[name](expected)
        docs = settle(stage(spark, docs, sf), name)
        assert {x.doc_id: (x.text, x.lang, x.source) for x in docs.collect()} == expected, name
        sizes.append(len(expected))
    before = [len(rows), *sizes]
    assert all(before[k] > sizes[k] for k in (0, 1, 3, 4)) and {x.doc_id for x in p.run(spark, sf).collect()} == set(expected)
