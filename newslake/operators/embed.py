"""Text to vectors through a pluggable embedder, with retries and error rows."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dimension of the vector table, attempts, and the failure text.
DIMENSION = 1536
ATTEMPTS = 3
GAVE_UP = "Max retries exceeded for embedding"

# An embedder maps n texts to an n x dimension matrix, and may raise.
Embedder = Callable[[pa.Array], np.ndarray]


class HashedWords:
    """Offline embedder: each word adds +1 or -1 to a slot chosen by its hash, and
    the vector is scaled to length 1. Works on whole Arrow batches; each distinct
    word of a batch is hashed once."""

    def __init__(self, dimension: int = DIMENSION):
        self.dimension = dimension

    def __call__(self, texts: pa.Array) -> np.ndarray:
        lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        words = pc.split_pattern_regex(lowered, r"[^\p{L}\p{N}]+")
        flat = pc.list_flatten(words)
        row = pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
        coded = pc.dictionary_encode(flat)
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        slots, signs = self._places(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy(zero_copy_only=False)
        matrix = np.bincount(
            row * self.dimension + slots[code],
            weights=signs[code],
            minlength=len(texts) * self.dimension,
        ).reshape(len(texts), self.dimension)
        return unit_rows(matrix)

    def _places(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        slots = np.zeros(len(words), dtype=np.int64)
        signs = np.zeros(len(words))
        for i, word in enumerate(words):
            if word:
                digest = hashlib.md5(word.encode()).hexdigest()
                slots[i] = int(digest[:8], 16) % self.dimension
                signs[i] = 1.0 if digest[8] < "8" else -1.0
        return slots, signs


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Scale rows to length 1; zero rows stay zero."""
    size = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, size, out=np.zeros_like(matrix, dtype=float), where=size > 0)


def _tried(embedder: Embedder, texts: pa.Array, waits: Sequence[float]) -> list | None:
    """Vectors of the texts in one call, after as many attempts as there are waits."""
    for wait in waits:
        try:
            return list(np.asarray(embedder(texts), dtype=np.float32))
        except Exception:
            time.sleep(wait)
    return None


def embed_batch(
    embedder: Embedder, texts: pa.Array, waits: Sequence[float]
) -> tuple[list, list]:
    """Vectors and errors of a batch.

    A batch that fails is retried whole, one wait after each attempt. Only then is it
    halved, each half tried once and halved in turn, until failing texts stand alone.
    Such a text is retried with the waits if any text has succeeded, so that the
    service answers; else its attempts in the batch count, and an outage costs each
    batch the waits once and two calls a text.
    """
    if len(texts) == 0:
        return [], []
    vectors = _tried(embedder, texts, waits)
    if vectors is None and len(texts) > 1:
        vectors = []
        answers = False
        open_parts = [texts.slice(len(texts) // 2), texts.slice(0, len(texts) // 2)]
        while open_parts:
            part = open_parts.pop()
            alone = len(part) == 1
            found = _tried(embedder, part, waits if alone and answers else [0])
            if found is None and not alone:
                half = len(part) // 2
                open_parts += [part.slice(half), part.slice(0, half)]
                continue
            answers = answers or found is not None
            vectors += found or [None]
    vectors = vectors or [None]
    return vectors, [GAVE_UP if v is None else None for v in vectors]


def embedded(
    text: Column, embedder: Embedder, waits: Sequence[float] | None = None
) -> Column:
    """Struct ``(vector, error)`` per text. Marked non-deterministic, so the
    planner neither repeats the call nor moves it before a filter that saves it."""
    pauses = [2**i for i in range(ATTEMPTS)] if waits is None else list(waits)
    kind = pa.struct([("vector", pa.list_(pa.float32())), ("error", pa.string())])

    @F.arrow_udf("struct<vector: array<float>, error: string>")
    def run(texts: pa.Array) -> pa.Array:
        vectors, errors = embed_batch(embedder, texts, pauses)
        return pa.StructArray.from_arrays(
            [pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())],
            fields=list(kind),
        )

    return run.asNondeterministic()(text)


def with_vectors(
    df: DataFrame,
    embedder: Embedder,
    text: str = "content",
    waits: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``vector`` and ``error``."""
    done = df.withColumn("_embedded", embedded(F.col(text), embedder, waits))
    return done.select(*df.columns, "_embedded.vector", "_embedded.error")
