"""Alignment of two tokenizations of the same texts by pointer jumping.

A is a byte-level vocabulary (tokenizers .json) over a space and the text, B a piece vocabulary (sentencepiece .model), which
puts that space itself. Both cover the same bytes, so an A and a B token are linked where their byte ranges overlap. Every token
points to its farthest-right overlapping token of the other side; one that ends where its partner ends is the terminal of its group and
points to itself. Doubling the successors (``next = next[next]``) over all tokens at once converges to each
component's terminal, which labels the group: the finest cut into spans where both sides end.

No token of either vocabulary reaches over the edge between a character that is no white space and a space (checked for B's
pieces when the vocabulary is loaded; A's pre-tokens end there), so a text is the sequence of its *units* cut at these edges, and a
distinct unit is encoded and aligned once per worker, however often it occurs.

Corpus-wide counts of linked id pairs are made in three steps. Tasks write one row per *chunk* of documents: the per-document numbers, the
distinct pairs of the chunk with their counts, and which units and pairs each document holds. Pairs are summed up over the chunks, and
the counts go back by (chunk, pair), never by document. Each chunk then finishes its documents on its own. A chunk holds at most about
``CHUNK_UNITS`` unit occurrences or one text.

A text that is null or empty, or whose A or B bytes differ from a space and the text (U+2581 itself, or text that B rewrites), has no
tokens: zeros and an empty digest. Repeated rows and null ids are documents of their own. An empty table gives an empty
result. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import BATCH_KEY, BATCH_ROWS, free_memory
from newslake.llm.token_counts import _byte_letters
from newslake.session import settle

CHUNK_UNITS = 1 << 20
MOST_UNITS = 150_000  # units a worker keeps; beyond, it ends its chunk and starts anew
EDGE = re.compile("(?<=[^\\s\u180e\u200b\ufeff]) ")
ENDS = re.compile("[^\\s\u180e\u200b\ufeff]\\Z")
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
LOW = (1 << 32) - 1


def _ends_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes)


def _spans(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of the given counts."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Terminal of every token, A's first and then B's: the number (among B's tokens) of the B token that ends its group.

    Ends are positions on one byte axis that both sides cover without gaps.
    """
    n = len(a_end)
    to_b = np.searchsorted(b_end, a_end)  # holds the last byte of an A token, hence reaches farthest right
    to_a = np.searchsorted(a_end, b_end)
    own = np.arange(len(b_end))
    following = np.concatenate([to_b + n, np.where(a_end[to_a] == b_end, own + n, to_a)])
    while True:
        doubled = following[following]
        if np.array_equal(doubled, following):
            return following - n
        following = doubled


class Aligner:
    """Both vocabularies, and the units aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁][▁ ]", p) for p in pieces):
            raise ValueError("a piece reaches over the edge before a space")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.space = self.b.piece_to_id("▁")
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, t in self.a_bytes.items():
            self.a_size[i] = len(t)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.fine = np.zeros(0, bool)
        self.numbers = np.zeros((0, len(NUMBERS)), np.int64)
        self.texts: list[str] = []
        self.first = np.zeros(1, np.int64)  # first pair of each unit
        self.pairs = np.zeros(0, np.int64)

    def units(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the units of each text."""
        parts = [EDGE.split(t) if t else [] for t in texts]
        known = self.index
        new = [u for u in dict.fromkeys(u for p in parts for u in p) if u not in known]
        if new:
            self._learn(new)
        return [np.fromiter(map(known.__getitem__, p), np.int32, len(p)) for p in parts]

    def _encode(self, new: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides, and which units both write unchanged.

        Units are encoded many at a time, as a text of them; the bytes tell where each ends. A unit that ends in white space would not
        end there, and goes alone.
        """
        left: list[list[int]] = [[]] * len(new)
        right: list[list[int]] = [[]] * len(new)
        fine = np.zeros(len(new), bool)
        inner, alone = [], []
        for k, u in enumerate(new):
            if ENDS.search(u):
                inner.append(k)
            else:
                alone.append([k])
        groups = [inner[k : k + 64] for k in range(0, len(inner), 64)] + alone
        texts = [" ".join([new[k] for k in g]) for g in groups]
        found = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        pieces = [y if t else [self.space] for t, y in zip(texts, self.b.encode(texts, num_threads=1), strict=True)]
        for g, t, x, y in zip(groups, texts, found, pieces, strict=True):
            if not self._split(g, new, t, x.ids, y, left, right, fine) and len(g) > 1:
                for k in g:  # one of them is not written unchanged
                    ids = self.a.encode(" " + new[k], add_special_tokens=False).ids
                    self._split([k], new, new[k], ids, self.b.encode(new[k]) if new[k] else [self.space], left, right, fine)
        return left, right, fine

    def _split(self, group: list[int], new: list[str], text: str, x: list[int], y: list[int], left: list, right: list, fine: np.ndarray) -> bool:
        whole = b" " + text.encode()
        if b"".join([self.a_bytes[i] for i in x]) != whole or b"".join([self.b_bytes[i] for i in y]) != whole:
            return False
        ends = np.cumsum([1 + (len(new[k]) if new[k].isascii() else len(new[k].encode())) for k in group])
        for ids, sizes, side in ((x, self.a_size, left), (y, self.b_size, right)):
            reached = np.cumsum(sizes[ids])
            cuts = np.searchsorted(reached, ends)
            if (reached[cuts] != ends).any():
                raise ValueError("a token reaches over the edge before a space")
            first = 0
            for k, last in zip(group, (cuts + 1).tolist(), strict=True):
                side[k], first = ids[first:last], last
        fine[group] = True
        return True

    def _learn(self, new: list[str]) -> None:
        left, right, fine = self._encode(new)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        good = np.flatnonzero(fine)
        count_a, count_b = (np.array([len(side[k]) for k in good], np.int64) for side in (left, right))
        a, b = (np.fromiter((i for k in good for i in side[k]), np.int64) for side in (left, right))
        a_end, b_end = _ends_of(self.a_size[a]), _ends_of(self.b_size[b])
        numbers = np.zeros((len(new), len(NUMBERS)), np.int64)
        per_unit = np.zeros(len(new), np.int64)
        strings = [""] * len(new)
        pairs = np.zeros(0, np.int64)
        if len(good):
            label = terminals(a_end, b_end)
            last = label[len(a) :] == np.arange(len(b))  # of B's tokens, the terminals
            group = np.cumsum(last) - last  # groups that ended before this B token
            group_a, group_b = group[label[: len(a)]], group[label[len(a) :]]
            unit_a, unit_b = np.repeat(np.arange(len(good)), count_a), np.repeat(np.arange(len(good)), count_b)
            low = np.searchsorted(b_end, a_end - self.a_size[a], side="right")
            many = np.searchsorted(b_end, a_end) - low + 1  # B tokens that overlap each A token
            pairs = (np.repeat(a, many) << 32) | b[np.repeat(low, many) + _spans(many)]
            links = np.bincount(unit_a, weights=many, minlength=len(good)).astype(np.int64)
            groups = np.bincount(unit_b[last], minlength=len(good))
            numbers[good] = np.stack([count_a, count_b, groups, links], axis=1)
            per_unit[good] = links
            for k, s in zip(good, self._written(a, b, group_a, group_b, groups), strict=True):
                strings[k] = s
        self.fine = np.concatenate([self.fine, fine])
        self.numbers = np.concatenate([self.numbers, numbers])
        self.texts += strings
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(per_unit)])
        self.pairs = np.concatenate([self.pairs, pairs])

    @staticmethod
    def _written(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, groups: np.ndarray) -> list[str]:
        """The groups of each unit as text: ids of A, a bar, ids of B."""
        n = int(groups.sum())
        sides = []
        for ids, group in ((a, group_a), (b, group_b)):
            names, cuts = list(map(str, ids.tolist())), np.searchsorted(group, np.arange(n + 1)).tolist()
            sides.append([names[x] if y - x == 1 else ",".join(names[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)])
        whole = [f"{x}|{y}" for x, y in zip(*sides, strict=True)]
        cuts = np.concatenate([[0], np.cumsum(groups)]).tolist()
        return [";".join(whole[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


CHUNKS = "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs array<long>, uses array<long>, sizes array<long>, packed binary"


class _Chunk:
    """Documents of a task until they make a row."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.digests: list[str] = []
        self.units: list[np.ndarray] = []
        self.held = 0

    def add(self, known: Aligner, doc_id: int | None, units: np.ndarray) -> None:
        if not known.fine[units].all():
            units = units[:0]
        self.ids.append(doc_id)
        text = ";".join([known.texts[u] for u in units.tolist()])
        self.digests.append(hashlib.sha256(text.encode()).hexdigest() if len(units) else "")
        self.units.append(units)
        self.held += len(units) + 1

    def row(self, known: Aligner, number: int) -> pa.RecordBatch:
        sizes = np.array([len(u) for u in self.units], np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        flat, at, count = np.unique(np.concatenate(self.units), return_inverse=True, return_counts=True)
        numbers = [np.bincount(doc, weights=known.numbers[flat, k][at], minlength=len(sizes)).astype(np.int64) for k in range(len(NUMBERS))]
        per_unit = known.first[flat + 1] - known.first[flat]
        linked = known.pairs[np.repeat(known.first[flat], per_unit) + _spans(per_unit)]
        pairs, which = np.unique(linked, return_inverse=True)
        uses = np.bincount(which, weights=np.repeat(count, per_unit), minlength=len(pairs)).astype(np.int64)
        arrays = [x.astype(np.int32) for x in (sizes, at, per_unit, which)]
        raw = b"".join(x.tobytes() for x in arrays)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        columns = [pa.array([number], pa.int64()), one(self.ids, pa.int64()), *(one(n, pa.int64()) for n in numbers), one(self.digests, pa.string()),
                   one(pairs, pa.int64()), one(uses, pa.int64()), one([len(x) for x in arrays], pa.int64()),
                   pa.array([pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True) if raw else b""], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "doc_id", *NUMBERS, "groups_sha256", "pairs", "uses", "sizes", "packed"])


def chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per chunk of documents, see the module."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk, done = aligner(a_path, b_path), _Chunk(), TaskContext.get().partitionId() << 32
        known.forget()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for first in range(0, len(ids), 200):
                part = slice(first, first + 200)
                for doc_id, units in zip(ids[part], known.units([t or "" for t in texts[part]]), strict=True):
                    chunk.add(known, doc_id, units)
                    if chunk.held >= CHUNK_UNITS:
                        yield chunk.row(known, done)
                        chunk, done = _Chunk(), done + 1
                if len(known.index) >= MOST_UNITS:
                    if chunk.ids:
                        yield chunk.row(known, done)
                        chunk, done = _Chunk(), done + 1
                    known.forget()
        if chunk.ids:
            yield chunk.row(known, done)
        known.forget()
        free_memory()

    conf = docs.sparkSession.conf
    if int(conf.get(BATCH_KEY, "10000")) > BATCH_ROWS:
        conf.set(BATCH_KEY, str(BATCH_ROWS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, CHUNKS)


def pair_counts(parts: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair in all chunks, and whether no other A id has more with that B id."""
    listed = parts.select(F.explode(F.arrays_zip("pairs", "uses")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.uses").alias("n"))
    counts = settle(listed.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(LOW)
    most = settle(counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most")), "best-counts")  # a row per B id at most
    return counts.withColumn("b", b_id).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finished(key: tuple, chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one chunk, given the corpus-wide counts of its pairs."""
    row = {c: chunk.column(c)[0].values for c in ["doc_id", *NUMBERS, "groups_sha256", "sizes"]}
    lengths = row["sizes"].to_numpy()
    packed = chunk.column("packed")[0].as_buffer()
    raw = pa.Codec("zstd").decompress(packed, decompressed_size=int(lengths.sum()) * 4, asbytes=True) if len(packed) else b""
    sizes, at, per_unit, which = np.split(np.frombuffer(raw, np.int32), np.cumsum(lengths)[:-1])
    n, best = np.zeros((2, counts.num_rows), np.int64)
    place = counts.column("at").to_numpy()
    n[place], best[place] = counts.column("n").to_numpy(), counts.column("best").to_numpy()

    def summed(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(lengths, dtype=np.int64)
        return total[ends] - total[ends - lengths]

    best, n = (summed(summed(v[which], per_unit)[at], sizes) for v in (best, n))
    columns = [row["doc_id"], *(row[c] for c in NUMBERS), pa.array(best), pa.array(n), row["groups_sha256"]]
    return pa.Table.from_arrays(columns, ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    parts = settle(chunks(docs, a_path, b_path), "chunks")
    places = parts.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    known = places.join(pair_counts(parts), "pair").select(F.col("chunk").alias("in_chunk"), "at", "n", "best")
    rows = parts.select("chunk", "doc_id", *NUMBERS, "groups_sha256", "sizes", "packed")
    return rows.groupBy("chunk").cogroup(known.groupBy("in_chunk")).applyInArrow(_finished, RESULT)
