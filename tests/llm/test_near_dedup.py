from __future__ import annotations

import random
import re

import numpy as np
import pytest

from newslake.llm import near_dedup

SCHEMA = "doc_id long, text string, component_id long, kept string"


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(ws[i : i + 4]) for i in range(len(ws) - 3)} if len(ws) >= 4 else ({tuple(ws)} if ws else set())


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def fixture():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgö") for _ in range(r.randint(1, 6)))
    prose = lambda n: [word() for _ in range(n)]
    rows = [(i, " ".join(prose(r.randint(1, 80)))) for i in range(40)]
    for g in range(6):
        base = prose(r.randint(60, 200))
        for k in range(12):
            ws = list(base)
            for _ in range(r.randint(0, 4)):
                ws[r.randrange(len(ws))] = word()
            rows.append((1000 + 37 * g + 3 * k, "\n".join(ws).upper() if k == 5 else " ".join(ws)))
    passage = prose(50)
    rows += [(2000 + i, " ".join(prose(20) + passage + prose(20))) for i in range(30)]
    rows += [(3000 + i, "one two three") for i in range(4)] + [(3100, "one two"), (3101, "ONE  two")]
    rows += [(3200, ""), (3201, None), (3202, " \n"), (3203, ""), (None, "one two three"), (5, rows[5][1])]
    chain = prose(100)
    for i in range(12):  # each is near the one before, the ends are not
        rows.append((4000 - i, " ".join(chain)))
        chain[(7 * i) % 100] = word()
    r.shuffle(rows)
    return rows


def test_against_all_pairs(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(4)
    want = brute(rows)
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    for g in got:
        if g.doc_id is None:
            assert g.component_id is None and g.kept
        else:
            assert (g.n_shingles, g.component_id, g.kept) == want[g.doc_id], g.doc_id


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_odd_sketch_estimates(similarity):
    rng = np.random.default_rng(2)
    n = 4000
    common = rng.integers(0, 2**63, int(2 * n * similarity / (1 + similarity)), dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, n - len(common), dtype=np.uint64)])) for _ in range(2)]
    sketches = [near_dedup.odd_sketches(near_dedup.signatures(s, np.array([0, len(s)]))) for s in sets]
    bits = np.bitwise_count(sketches[0] ^ sketches[1]).sum(axis=1)
    assert abs(near_dedup.estimate(bits)[0] - similarity) < 0.12
    assert near_dedup.LEAST < 0.65


def test_set_sketches_never_exceed_the_symmetric_difference():
    rng = np.random.default_rng(5)
    for size in (1, 40, 900, 6000):
        x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: size * 4 // 5], rng.integers(0, 2**64, size // 5 + 1, dtype=np.uint64)]))
        both = near_dedup.set_sketches(np.concatenate([x, y]), np.array([0, len(x), len(x), len(x) + len(y)]))
        assert both.shape == (2, near_dedup.SKETCH_BITS // 8)
        assert np.unpackbits(both[0] ^ both[1]).sum() <= len(np.setxor1d(x, y))
