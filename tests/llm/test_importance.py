from __future__ import annotations

import hashlib
import math
import re
import zlib

import pytest

from newslake.llm import importance
from tests.llm import odd_texts


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text, longest):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def expected(docs, target, longest, buckets, percent):
    found = [features(t, longest) for _, t in docs]
    counts = [[0] * buckets, [0] * buckets]
    for side, lists in enumerate((found, [features(t, longest) for t in target])):
        for x in (x for xs in lists for x in xs):
            counts[side][x % buckets] += 1
    s, t = sum(counts[0]), sum(counts[1])
    gain = [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(*counts, strict=True)]
    rows = []
    for (i, text), f in zip(docs, found, strict=True):
        weight = sum(gain[x % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize(("longest", "buckets", "percent", "part"), [(1, 10_000, 10, 1 << 22), (3, 97, 60, 50)])
def test_against_plain_counting(spark, monkeypatch, longest, buckets, percent, part):
    monkeypatch.setattr(importance, "PART_BYTES", part)
    texts = odd_texts.texts()
    target = spark.createDataFrame([(1, t) for t in texts[:3] + texts[30:40]], "score long, text string")
    got = importance.resample(odd_texts.table(spark, texts), target, longest, buckets, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    rows = expected([*enumerate(texts), (None, "a b")], [r.text for r in target.collect()], longest, buckets, percent)
    assert sorted(map(tuple, got.collect()), key=str) == rows


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    """All keys equal: linear probing and the byte comparison alone keep the n-grams apart."""
    monkeypatch.setattr(importance.xxhash, "xxh64_intdigest", lambda g: len(g) % 2)
    grams = [bytes([97 + k % 7]) * (1 + k % 3) for k in range(200)]
    table = importance.intern(grams, 1000)
    assert len(set(table.slot.tolist())) == len(set(grams))
    for g, s in zip(grams, table.slot, strict=True):
        assert table.bucket[s] == zlib.crc32(g) % 1000 and table.count[s] == grams.count(g)


def test_empty_tables_and_repeated_rows(spark):
    docs = odd_texts.table(spark, ["one two " * 12] * 5)
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    assert {r.weight for r in importance.resample(docs, none).collect() if r.n_words == 24} == {importance.gains(docs, none)[zlib.crc32(b"one") % 10_000]}
    twice = importance.resample(docs.unionByName(docs), docs, percent=100).collect()
    assert sorted(r["rank"] for r in twice if r.n_words == 24) == list(range(1, 11))
