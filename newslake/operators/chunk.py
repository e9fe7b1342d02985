"""Splitting articles into overlapping chunks."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the ingest: chunk size, overlap, and where to break first.
CHUNK_SIZE = 700
CHUNK_OVERLAP = 100
SEPARATORS = ["\n\n", "\n", ".", " ", ""]

Span = tuple[int, int]


def _pieces(text: str, span: Span, separator: str) -> list[Span]:
    """Cut a span before each separator, so a separator starts its piece."""
    start, end = span
    if separator == "":
        return [(i, i + 1) for i in range(start, end)]
    cuts = [m.start() for m in re.compile(re.escape(separator)).finditer(text, start, end)]
    bounds = [start, *[c for c in cuts if c > start], end]
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def _packed(pieces: list[Span], size: int, overlap: int) -> Iterator[Span]:
    """Join neighbouring pieces into spans of at most ``size`` characters.

    After a span is given out, its last pieces that fit in ``overlap`` and leave
    room for the next piece open the following span.
    """
    held: deque[Span] = deque()
    for piece in pieces:
        if held and piece[1] - held[0][0] > size:
            yield held[0][0], held[-1][1]
            while held and (
                held[-1][1] - held[0][0] > overlap or piece[1] - held[0][0] > size
            ):
                held.popleft()
        held.append(piece)
    if held:
        yield held[0][0], held[-1][1]


def _spans(text: str, span: Span, separators: list[str], size: int, overlap: int) -> Iterator[Span]:
    """Chunk spans of a text, by the first separator it contains.

    A piece that is still too long is split by the next separators on its own,
    without overlap to its neighbours.
    """
    level = next(
        i for i, s in enumerate(separators) if s == "" or text.find(s, span[0], span[1]) >= 0
    )
    finer = separators[level + 1 :]
    fitting: list[Span] = []
    for piece in _pieces(text, span, separators[level]):
        if piece[1] - piece[0] < size or not finer:
            fitting.append(piece)
            continue
        yield from _packed(fitting, size, overlap)
        fitting = []
        yield from _spans(text, piece, finer, size, overlap)
    yield from _packed(fitting, size, overlap)


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Chunks of one text, stripped, empty ones dropped."""
    if not text:
        return []
    cut = (text[a:b].strip() for a, b in _spans(text, (0, len(text)), SEPARATORS, size, overlap))
    return [c for c in cut if c]


def separated_chunks(
    content: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> Column:
    """Chunks that break at paragraph, line, sentence or word where possible.

    Only the text column crosses to Python, in Arrow batches.
    """

    @F.arrow_udf("array<string>")
    def split_batch(texts: pa.Array) -> pa.Array:
        found = [split_text(t, size, overlap) if t else [] for t in texts.to_pylist()]
        return pa.array(found, pa.list_(pa.string()))

    return split_batch(content)


def separated_spans(
    content: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> Column:
    """Where the chunks lie before they are stripped: characters ``begin`` to ``upto``, counted from 0."""

    @F.arrow_udf("array<struct<begin: int, upto: int>>")
    def spans_of_batch(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("upto", pa.int32())]))
        found = [list(_spans(t, (0, len(t)), SEPARATORS, size, overlap)) if t else [] for t in texts.to_pylist()]
        return pa.array([[{"begin": a, "upto": b} for a, b in f] for f in found], kind)

    return spans_of_batch(content)


def fixed_chunks(content: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` characters every ``size - overlap``; built-ins only.

    The last window is the first one that reaches the end of the text.
    """
    stride = size - overlap
    length = F.length(content)
    count = F.greatest(F.ceil((length - overlap) / stride), F.lit(1)).cast("int")
    starts = F.sequence(F.lit(0), count - 1)
    windows = F.transform(
        starts, lambda i: F.substring(content, i * F.lit(stride) + 1, F.lit(size))
    )
    return F.when(length > 0, windows).otherwise(F.array().cast("array<string>"))


def chunk_rows(articles: DataFrame, chunks: Column, size_of_text: str = "content") -> DataFrame:
    """One row per chunk: the chunk becomes ``content``, the whole text goes to
    ``full_content``, and ``chunk_index`` counts from 0."""
    others = [c for c in articles.columns if c != size_of_text]
    return articles.select(
        *others, F.col(size_of_text).alias("full_content"),
        F.posexplode(chunks).alias("chunk_index", "content"),
    )
