from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from newslake.llm import suffix_dedup
from newslake.llm.suffix_sort import sort_suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def brute(rows):
    """Every 100-byte string of every document, in order of id."""
    seen, out = {}, {}
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id if doc_id is not None else -1, (text or "").encode())
    for key in sorted(texts):
        data = texts[key]
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            part = data[i : i + 100]
            if part in seen:
                gone[i : i + 100] = True
            else:
                seen[part] = key
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[key] = (len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest(), kept)
    return out


def fixture():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeéßü") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line, base = prose(40), prose(20), prose(150)
    rows = [(i, prose(r.randint(1, 60))) for i in range(20)]
    rows += [(100 + i, prose(10) + passage[r.randint(0, 9) :] + prose(10)) for i in range(40)]
    for i in range(25):
        ws = base.split(" ")
        for _ in range(3):
            ws[r.randrange(len(ws))] = word()
        rows.append((200 + i, " ".join(ws)))
    rows += [(300 + i, base) for i in range(8)]
    rows += [(400, "a" * 1500), (401, "ab" * 900), (402, (line + "\n") * 12), (403, "x" * 99), (404, "a" * 100)]
    rows += [(500, ""), (501, None), (502, " "), (503, base + passage), (503, base + passage), (None, passage)]
    r.shuffle(rows)
    return rows


def check(spark, rows):
    df = spark.createDataFrame([(i, t, None, "s", None, "x") for i, t in rows], SCHEMA).repartition(5)
    got = suffix_dedup.remove_repeats(df).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for g in got:
        w = want[g.doc_id if g.doc_id is not None else -1]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256, bytes(g.kept)) == w, g.doc_id


def test_against_all_strings(spark):
    check(spark, fixture())


@pytest.mark.parametrize("most_blocks, starts", [(1, 50), (3, 1 << 20)])
def test_crowded_minima(spark, monkeypatch, most_blocks, starts):
    monkeypatch.setattr(suffix_dedup, "MOST_BLOCKS", most_blocks)
    monkeypatch.setattr(suffix_dedup, "SORT_STARTS", starts)
    check(spark, fixture())


LINE = "a line of forty bytes, repeated in a row"
PROSE = "".join(random.Random(9).choice("klmnopq rst") for _ in range(300))


@pytest.mark.parametrize("text", ["a" * 150, "a" * 355, "ab" * 70, *(LINE * n for n in (3, 4, 5)), PROSE + LINE * 4 + PROSE[::-1], "é" * 80])
def test_repeats_inside_one_block(spark, text):
    """The only text with its minimum: its repeats are its own."""
    check(spark, [(7, text)])
    check(spark, [(7, text), (8, PROSE), (9, text), (9, text), (10, "x" + text)])


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_flagged_classes_across_batches(size):
    """Every split into batches sends on the same blocks, each once."""
    rows = [(1, 2, 1, 1), (2, 3, 1, 2), (2, 3, 2, 2), (3, 5, 1, 3), (3, 6, 1, 4), (4, 6, 1, 5), (4, 7, 2, 5), (5, 8, 1, 6), (6, 9, 1, 7)]
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], ["h", "b", "doc", "pack"]) for part in parts]
    got = [tuple(r.values()) for out in suffix_dedup._meet(iter(batches)) for r in out.to_pylist()]
    assert sorted(g for g in got if g[0] is None) == [(None, 2, 2)]
    assert sorted(g for g in got if g[0] is not None) == [(2, 1, 2), (3, 1, 3), (3, 1, 4), (4, 1, 5), (4, 2, 5), (6, 1, 7)]


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh"])
def test_order_of_suffixes(alphabet):
    r = random.Random(1)
    text = "".join(r.choice(alphabet) for _ in range(400))
    data = np.frombuffer((text * 3 + "a" * 300).encode(), np.uint8)
    positions = np.array(r.sample(range(len(data) - 100), 500))
    order, new = sort_suffixes(data, positions, 100)
    strings = [data[p : p + 100].tobytes() for p in positions]
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    assert [bool(n) for n in new] == [True] + [a != b for a, b in zip(ordered, ordered[1:])]
