from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations_with_replacement
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newslake.llm import packing
from newslake.llm.textbytes import runs
from tests.llm import odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, window):
    """Every id lies in exactly one piece, checksums hold, and sequences are gapless, within the window and unpadded."""
    library = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc32(ids[at : at + r.length].tobytes())) and r.length > 0
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or (at < window and at & (at - 1) == 0)


@pytest.mark.parametrize(("window", "block"), [(4096, 1 << 18), (64, 100), (256, 37)])
def test_every_id_once_and_no_padding(spark, monkeypatch, window, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    texts = dict(enumerate(odd_texts.texts()))
    got = packing.pack(odd_texts.table(spark, list(texts.values())), PATH, window)
    assert got.columns == packing.OUT
    check(got.collect(), texts | {None: "a b"}, window)


def test_given_up_sequences_and_one_length(spark):
    """Remainders that combinations take whole leave no tape: sequences are given up to fill the open space of the others."""
    for size, count in ((300, 130), (1, 700), (505, 8), (2048, 5)):
        texts = {i: "a " * (size - 1) for i in range(count)}
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        check(packing.pack(df, PATH).collect(), texts, 4096)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.length) for r in packing.pack(df, PATH).collect()) == [(0, 1), (0, 1), (1, 4), (1, 4)]
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_combinations_are_all_sums():
    plain = {c for n in range(1, 5) for c in combinations_with_replacement(range(1, 13), n) if sum(c) == 12}
    found = packing.combinations(12, 4).astype(int)
    assert {tuple(np.repeat(np.arange(1, 13), f)) for f in found.T} == plain


def test_least_squares_against_projected_gradient():
    r = np.random.default_rng(1)
    for _ in range(20):
        a, b = r.integers(0, 4, (6, 15)).astype(float), r.integers(0, 50, 6).astype(float)
        x, rate = np.zeros(15), 1 / np.linalg.norm(a, 2) ** 2
        for _ in range(20_000):
            x = np.maximum(0, x - rate * (a.T @ (a @ x - b)))
        got = packing.nonnegative_least_squares(a, b)
        assert (got >= 0).all() and np.linalg.norm(a @ got - b) <= np.linalg.norm(a @ x - b) + 1e-6


def test_plan_stays_within_the_histogram():
    r = np.random.default_rng(2)
    for _ in range(20):
        histogram = (r.random(32) ** 4 * 10_000).astype(int)
        ways, times = packing.repeats(histogram)
        assert (ways @ times <= histogram).all() and (ways.T @ np.arange(1, 33) == 32).all()
        places = defaultdict(list)
        for length, after, upto, _, _ in packing.plan(histogram):
            places[length] += range(after, upto)
        assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_ids_are_the_librarys():
    """Contractions, digits, signs, odd bytes, added tokens and long pieces, texts side by side without a space between them."""
    r = random.Random(7)
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", "LL", "Re", "a", "the", "1", "42", "!", "--", " ", "\n", "é", "Ünï", "漢", "\x00", "<|endoftext|>", "<|", "x" * 40, " ", "İ", "́"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(4000)] + [t for t in odd_texts.texts() if t]
    encoder, library, at = packing.WordEncoder(PATH), Tokenizer.from_file(PATH), 0
    for run in runs(pa.array(texts), 1 << 14):
        ids, begin = encoder.encode(run)
        for k, text in enumerate(texts[run.first : run.last]):
            assert ids[begin[k] : begin[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text[:200]
            at += 1
    assert at == len(texts)
