"""Texts of an Arrow batch as flat byte arrays, and vectorised work on them inside tasks.

A batch is cut into runs of whole documents of about ``RUN_BYTES`` bytes, so that the
working arrays stay small however many rows a batch has. A document longer than
that makes a run of its own; memory is then a small multiple of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 19
M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xC2B2AE3D27D4EB4F)
BYTE_CODES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Run:
    """Whole documents ``first .. last-1`` of a batch; text i is ``data[starts[i]:starts[i+1]]``."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def owners(self, positions: np.ndarray) -> np.ndarray:
        """The document (index within the run) that holds each byte position."""
        return np.searchsorted(self.starts, positions, side="right") - 1


def runs(column: pa.Array, target: int = RUN_BYTES) -> Iterator[Run]:
    """Runs of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + target, side="right")) - 1
        last = min(max(last, first + 1), n)
        lo = offsets[first]
        yield Run(first, last, body[lo : offsets[last]], offsets[first : last + 1] - lo)
        first = last


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes, order kept."""
    x = a * M1
    x += b
    x ^= x >> np.uint64(32)
    x *= M2
    x ^= x >> np.uint64(29)
    return x


def window_hashes(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """64-bit hashes of all windows of each given length, by doubling.

    Array i has ``len(data) - length + 1`` entries (none if the data are shorter).
    Windows that cross documents are hashed too; callers mask them.
    """
    out: dict[int, np.ndarray] = {}
    h, size = BYTE_CODES[data], 1
    for length in sorted(lengths):
        while size * 2 <= length and len(h) > size:
            h = mix(h[:-size], h[size:])
            size *= 2
        rest = length - size
        if len(data) < length:
            out[length] = np.zeros(0, np.uint64)
        else:
            out[length] = h if rest == 0 else mix(h[: len(h) - rest], h[rest:])
    return [out[n] for n in lengths]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each full window of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return values if rest == 0 else np.minimum(values[: len(values) - rest], values[rest:])


def words(run: Run, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the runs of bytes other than white space, never across documents.

    The hash of a word depends on its bytes only.
    """
    data = LOWER[run.data] if lower else run.data
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = run.starts[:-1][run.lengths > 0]
    begins[heads] = inside[heads]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | begins[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(finish) + 1
    return start, end, span_hashes(data, start, end)


_POWERS = np.zeros(0, np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_CACHE: dict[str, np.ndarray] = {"up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``data[start:end]``: a polynomial over random byte codes, mixed with the length."""
    n = len(data) + 1
    if len(_CACHE["up"]) < n:
        _CACHE["up"], _CACHE["down"] = _powers(_BASE, n), _powers(_INVERSE, n)
    sums = np.zeros(n, np.uint64)
    np.cumsum(BYTE_CODES[data] * _CACHE["up"][: n - 1], out=sums[1:])
    raw = (sums[end] - sums[start]) * _CACHE["down"][start]
    return mix(raw, (end - start).astype(np.uint64))
