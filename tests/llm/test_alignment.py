from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from newslake.llm import alignment
from tests.llm import odd_texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ends(tokens):
    return np.cumsum([len(t) for t in tokens]).tolist()


def plain(known, text):
    """Ids of both sides, links and the written groups of a text encoded as a whole; None without tokens."""
    if not text:
        return None
    a, b = known.a.encode(" " + text, add_special_tokens=False).ids, known.b.encode(text)
    of_a, of_b = [known.a_bytes[i] for i in a], [known.b_bytes[i] for i in b]
    if not b"".join(of_a) == b"".join(of_b) == b" " + text.encode():
        return None
    end_a, end_b = ends(of_a), ends(of_b)
    links, first = [], 0
    for i, (x, e) in enumerate(zip(of_a, end_a, strict=True)):
        while end_b[first] <= e - len(x):
            first += 1
        k = first
        while k < len(b) and end_b[k] - len(of_b[k]) < e:
            links.append((a[i], b[k]))
            k += 1
    groups, i, k = [], 0, 0
    for cut in sorted(set(end_a) & set(end_b)):
        sides = []
        for ids, end, start in ((a, end_a, i), (b, end_b, k)):
            stop = start
            while stop < len(ids) and end[stop] <= cut:
                stop += 1
            sides.append((ids[start:stop], stop))
        groups.append("|".join(",".join(map(str, ids)) for ids, _ in sides))
        i, k = sides[0][1], sides[1][1]
    return len(a), len(b), groups, links


def expected(texts):
    known = alignment.Aligner(A, B)
    found = [plain(known, t) for t in texts]
    counts = Counter(x for f in found if f for x in f[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        rows.append((a, b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows


@pytest.mark.parametrize(("chunk", "kept"), [(1 << 20, 150_000), (60, 100)])
def test_against_whole_texts(spark, monkeypatch, chunk, kept):
    monkeypatch.setattr(alignment, "CHUNK_UNITS", chunk)
    monkeypatch.setattr(alignment, "MOST_UNITS", kept)
    texts = odd_texts.texts()
    got = alignment.align(odd_texts.table(spark, texts), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    assert len(rows) == len(texts) + 1
    for i, row in enumerate(expected([*texts, "a b"])):
        assert rows[i if i < len(texts) else None] == row, texts[i : i + 1]


def test_terminals_are_those_of_connected_ranges():
    r = np.random.default_rng(3)
    for _ in range(200):
        n = int(r.integers(1, 60))
        a, b = (np.append(np.flatnonzero(r.random(n - 1) < p) + 1, n) for p in r.random(2))
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        own = [next(s for s in shared if s >= e) for e in [*a.tolist(), *b.tolist()]]
        assert b[alignment.terminals(a, b)].tolist() == own


def test_empty_table(spark):
    assert alignment.align(odd_texts.table(spark, []).limit(0), A, B).count() == 0
    assert {tuple(r)[1:] for r in alignment.align(odd_texts.table(spark, [None, ""]).where("doc_id is not null"), A, B).collect()} == {(0,) * 6 + ("",)}
