"""Chunkers against plain definitions and their promises."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newslake.operators import chunk

words = st.text(alphabet="ab .\n", max_size=400)


def slow_split(text, seps, size, overlap):
    """The same contract on lists of strings."""
    sep = next(s for s in seps if s == "" or s in text)
    rest = seps[seps.index(sep) + 1:]
    parts = list(text) if sep == "" else re.split(f"(?={re.escape(sep)})", text)
    if sep == "\n\n":  # non-overlapping, from the left
        found = re.split("(\n\n)", text)
        parts = [found[0]] + [a + b for a, b in zip(found[1::2], found[2::2])]
    out, run = [], []

    def flush():
        held = []
        for p in run:
            if held and sum(map(len, held)) + len(p) > size:
                out.append("".join(held))
                while held and (sum(map(len, held)) > overlap
                                or sum(map(len, held)) + len(p) > size):
                    held = held[1:]
            held = held + [p]
        if held:
            out.append("".join(held))
        run.clear()

    for p in (p for p in parts if p):
        if len(p) < size or not rest:
            run.append(p)
        else:
            flush()
            out.extend(slow_split(p, rest, size, overlap))
    flush()
    return out


@settings(max_examples=300, deadline=None)
@given(words, st.integers(5, 40), st.integers(0, 4))
def test_same_as_the_definition(text, size, overlap):
    want = [c.strip() for c in slow_split(text, chunk.SEPARATORS, size, overlap)] if text else []
    assert chunk.split_text(text, size, overlap) == [c for c in want if c]


@settings(max_examples=200, deadline=None)
@given(words, st.integers(5, 40), st.integers(0, 4))
def test_promises(text, size, overlap):
    chunks = chunk.split_text(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    at = 0
    for c in chunks:  # in order, sharing no more than the overlap
        at = text.index(c, max(0, at - overlap)) + len(c)
    # Nothing but white space is lost: dropping each overlap gives the text back.
    kept, rest = re.sub(r"\s", "", "".join(chunks)), re.sub(r"\s", "", text)
    assert len(kept) >= len(rest) and set(rest) <= set(kept)


def test_sizes_at_the_bounds():
    assert chunk.split_text("x") == ["x"]
    assert chunk.split_text("x" * 700) == ["x" * 700]
    assert [len(c) for c in chunk.split_text("x" * 701)] == [700, 101]
    assert [len(c) for c in chunk.split_text("x" * 5000)][:2] == [700, 700]
    long = "wort " * 1000
    assert all(len(c) <= 700 for c in chunk.split_text(long))
    assert chunk.split_text("") == [] and chunk.split_text(" \n ") == []


def test_breaks_at_the_strongest_separator():
    text = "a" * 400 + "\n\n" + "b" * 400
    assert chunk.split_text(text) == ["a" * 400, "b" * 400]


def test_column_forms(spark):
    text = "abc. " * 400
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, content string")
    separated = chunk.chunk_rows(rows, chunk.separated_chunks(F.col("content"))).collect()
    assert [r.content for r in separated] == chunk.split_text(text)
    assert [r.chunk_index for r in separated] == list(range(len(separated)))
    assert {r.full_content for r in separated} == {text}
    fixed = chunk.chunk_rows(rows, chunk.fixed_chunks(F.col("content"))).collect()
    assert [r.content for r in fixed] == [text[i:i + 700] for i in range(0, 1900, 600)]
