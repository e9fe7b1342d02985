"""Exact removal of repeated byte strings across documents, by sorted suffixes.

A byte goes if a string of ``N`` bytes that covers it also starts earlier (in a document
with a smaller id, or in the same one further left). Sorting every suffix of a corpus
would shuffle many times its size, so the suffixes are found in three exact steps:

1. *Anchors.* Every N-byte string has a minimal hash among its K-byte grams. Starts in a
   row with the same minimum form a block. Equal strings lie in blocks of the same minimum, so
   only blocks whose minimum occurs elsewhere, or that hold a string twice themselves, matter. Blocks that
   are equal as a whole are settled by their hash (with the minimum, 127 bits): all but the earliest go.
2. *Suffixes.* Where blocks of one minimum differ or one of them holds a string twice, the starts inside are compared: the texts of the blocks
   meet per minimum, their suffixes are ordered by deep-shallow sorting, and equal neighbours
   are repeats. A minimum with very many different blocks (the edge of a passage that a
   third of all documents share) is dealt out by the string instead of the minimum:
   each task sorts the suffixes it has, keeps the earliest of equal ones, and the
   survivors meet by a 128-bit hash of the string. Both ways give the same rows.
3. *Removal.* Start ranges are collected per document and joined with its text.

Equal blocks are combined within a batch before the shuffle, so a hot block costs one row
per batch. Texts travel compressed. Lists are per document, bounded by its length.

Null text is empty, has no strings, and keeps the hash of no bytes. Rows that repeat both id and
text are the same document and get the same result each. A null id sorts before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import SMALLEST, free_memory, map_batches, pack_texts, text_or_empty, unpack_texts
from newslake.llm.suffix_sort import sort_suffixes
from newslake.llm.textbytes import M1, mix, runs, sliding_min, window_hashes
from newslake.session import settle

N = 100  # length of a repeated string, in bytes
K = 32  # length of the grams that anchor a string
MOST_STARTS = 128  # starts in one block
MOST_BLOCKS = 2048  # different blocks of one minimum that are sorted together; beyond it, by string
SORT_STARTS = 1 << 18  # suffixes sorted at once
VERSION = 0xFFFFFF
ONE = np.uint64(1)
_RANKS = np.multiply.accumulate(np.full(MOST_STARTS, 0xD6E8FEB86659FD93, np.uint64))


def _pack(start: np.ndarray, count: np.ndarray, version: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 32) | (count.astype(np.int64) << 24) | version.astype(np.int64)


def _unpack(pack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return pack >> 32, (pack >> 24) & 0xFF, pack & VERSION


def _blocks(run) -> tuple[np.ndarray, ...]:
    """Per block of a run: owner, first start (within the document), number of starts, minimum, hash.

    The hash is odd if the block holds a string twice; equal blocks have equal hashes.
    """
    data = run.data
    empty = np.zeros(0, np.int64)
    if len(data) < N:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    gram, whole = window_hashes(data, K, N)
    least = sliding_min(gram, N - K + 1)
    owner = np.repeat(np.arange(len(run.lengths)), run.lengths)
    starts = np.flatnonzero(owner[: len(least)] == owner[N - 1 :])
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    least = least[starts]
    cut = np.ones(len(starts), bool)
    cut[1:] = (least[1:] != least[:-1]) | (np.diff(starts) != 1)
    heads = np.flatnonzero(cut)
    rank = np.arange(len(starts)) - np.repeat(heads, np.diff(np.append(heads, len(starts))))
    heads = np.flatnonzero(rank % MOST_STARTS == 0)
    count = np.diff(np.append(heads, len(starts)))
    value = np.add.reduceat(whole[starts] * _RANKS[rank % MOST_STARTS], heads)
    value = (mix(value, count.astype(np.uint64)) & ~ONE) | _holds_twice(gram[starts] == least, whole[starts], heads, count)
    first = starts[heads]
    return owner[first], first - run.starts[owner[first]], count, least[heads], value


def _holds_twice(at_least: np.ndarray, string: np.ndarray, heads: np.ndarray, count: np.ndarray) -> np.ndarray:
    """1 for each block with equal strings at two of its starts, else 0.

    Two equal strings hold the minimum at the same offset, so the first one's minimum is passed inside the block: some
    start other than the block's last begins with it (``at_least``). Only such blocks, few in prose, are sorted.
    """
    inner = at_least.copy()
    inner[heads + count - 1] = False
    suspects = np.flatnonzero(np.logical_or.reduceat(inner, heads))
    out = np.zeros(len(heads), np.uint64)
    if len(suspects):
        size = count[suspects]
        block = np.repeat(suspects, size)
        rows = np.arange(len(block)) + np.repeat(heads[suspects] - (np.cumsum(size) - size), size)
        found = string[rows]
        order = np.lexsort((found, block))
        found, block = found[order], block[order]
        out[block[1:][(found[1:] == found[:-1]) & (block[1:] == block[:-1])]] = ONE
    return out


def _combine(a, b, doc, pack) -> np.ndarray:
    """Flags of the rows that repeat an earlier row of the same (a, b)."""
    again = np.zeros(len(a), bool)
    order = np.argsort(a ^ (b * M1), kind="stable")
    key = (a ^ (b * M1))[order]
    twin = np.zeros(len(a), bool)
    twin[1:] = key[1:] == key[:-1]
    twin[:-1] |= twin[1:].copy()
    rows = order[twin]
    rows = rows[np.lexsort((pack[rows], doc[rows], b[rows], a[rows]))]
    if len(rows):
        new = np.ones(len(rows), bool)
        new[1:] = (a[rows][1:] != a[rows][:-1]) | (b[rows][1:] != b[rows][:-1])
        head = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
        again[rows] = (doc[rows] != doc[head]) | (pack[rows] != pack[head])
    return again


ANCHORS = "h long, b long, doc long, pack long"


def _anchors(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """One row per block; a negative pack marks a block known to repeat an earlier one of its batch."""
    docs, versions = batch.column("doc").to_numpy(), batch.column("version").to_numpy()
    parts = []
    for run in runs(batch.column("text")):
        owner, start, count, least, value = _blocks(run)
        rows = owner + run.first
        parts.append((least, value, docs[rows], _pack(start, count, versions[rows])))
    if not parts:
        return []
    h, b, doc, pack = (np.concatenate(x) for x in zip(*parts, strict=True))
    again = _combine(h, b, doc, pack)
    h = np.where(again, mix(doc.view(np.uint64), pack.view(np.uint64)), h)  # nothing to meet: spread
    pack = np.where(again, -1 - pack, pack)
    columns = [h.view(np.int64), b.view(np.int64), doc, pack]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "b", "doc", "pack"]),


RANGES = "h long, doc long, pack long"


def _rows(h, doc, pack) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([h, pa.array(doc), pa.array(pack)], ["h", "doc", "pack"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, b, doc, pack) to ranges: h null for starts that go, else a block to compare.

    A class is compared if its minimum has another class, or if its blocks hold a string twice (b is odd).
    Only the first row of the class at hand and the first block of the minimum at hand
    are carried from batch to batch.
    """
    now = None  # (h, b, doc, pack) of the first row of the class at hand
    waiting = None  # (h, doc, pack) of the only class so far of the minimum at hand
    for batch in batches:
        h, b, doc, pack = (batch.column(c).to_numpy() for c in ("h", "b", "doc", "pack"))
        known = pack < 0
        if known.any():
            yield _rows(pa.nulls(int(known.sum()), pa.int64()), doc[known], -1 - pack[known])
            h, b, doc, pack = h[~known], b[~known], doc[~known], pack[~known]
        n = len(h)
        if not n:
            continue
        before = (np.array([x], np.int64) for x in now) if now else (np.array([~x[0]]) for x in (h, b, doc, pack))
        h, b, doc, pack = (np.concatenate([x, y]) for x, y in zip(before, (h, b, doc, pack), strict=True))
        new_h = np.ones(n + 1, bool)
        new_h[1:] = h[1:] != h[:-1]
        new_class = new_h.copy()
        new_class[1:] |= b[1:] != b[:-1]
        heads = np.flatnonzero(new_class)
        head = heads[np.cumsum(new_class) - 1]
        gone = (doc != doc[head]) | (pack != pack[head])
        yield _rows(pa.nulls(int(gone.sum()), pa.int64()), doc[gone], pack[gone])
        # heads[0] is the carried class: whether it is a block to compare was or is decided by ``waiting``.
        more = ~new_h[heads]
        follows = np.append(more[1:], False)
        chosen = more | follows | ((b[heads] & 1) == 1)
        chosen[0] = False
        if waiting and len(heads) > 1 and more[1]:
            yield _rows(pa.array([waiting[0]], pa.int64()), [waiting[1]], [waiting[2]])
            waiting = None
        elif len(heads) > 1:
            waiting = None
        last = heads[-1]
        if len(heads) > 1 and not chosen[-1]:
            waiting = (int(h[last]), int(doc[last]), int(pack[last]))
        c = heads[chosen]
        if len(c):
            yield _rows(pa.array(h[c]), doc[c], pack[c])
        now = tuple(int(x[head[-1]]) for x in (h, b, doc, pack))
    free_memory()


PACKED = "doc_id long, doc long, version int, n_bytes long, packed binary"


def _compress(carry: list[str]):
    """Texts compressed, beside the ids and carried columns."""

    def f(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = [batch.column(c) for c in ("doc_id", "doc", "version")]
        out += [*pack_texts(batch.column("text")), *(batch.column(f"_{c}") for c in carry)]
        return [pa.RecordBatch.from_arrays(out, ["doc_id", "doc", "version", "n_bytes", "packed", *(f"_{c}" for c in carry)])]

    return f


def _texts(batch: pa.RecordBatch, first: int, last: int) -> list[bytes]:
    part = batch.slice(first, last - first)
    return unpack_texts(part.column("n_bytes"), part.column("packed"))


def _pieces(batch: pa.RecordBatch, target: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``target`` bytes."""
    ends = np.cumsum(batch.column("n_bytes").to_numpy())
    first = 0
    while first < len(ends):
        base = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, base + target, side="right")), first + 1)
        yield first, last
        first = last


COMPARED = "key long, second long, doc long, start int, version int, body binary"


def _spread_starts(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Blocks with their bytes; starts of crowded minima by the hash of their string, the earliest of equal ones."""
    out = []
    doc_ids, versions = batch.column("doc").to_numpy(), batch.column("version").to_numpy()
    lists = batch.column("blocks")
    for first, last in _pieces(batch, 1 << 20):
        texts = _texts(batch, first, last)
        keys, bodies, docs, starts, marks = [], [], [], [], []
        base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        data = np.frombuffer(b"".join(texts), np.uint8)
        crowded = []
        for i, text in enumerate(texts):
            part = lists[first + i].values
            h, pack = part.field("h").to_numpy(), part.field("pack").to_numpy()
            many = part.field("crowded").to_numpy(zero_copy_only=False)
            s, c, _ = _unpack(pack)
            for j in np.flatnonzero(~many):
                keys.append(h[j])
                bodies.append(text[s[j] : s[j] + c[j] + N - 1])
                docs.append(doc_ids[first + i])
                starts.append(s[j])
                marks.append(versions[first + i])
            if many.any():
                ends = np.cumsum(c[many])
                inner = np.arange(ends[-1]) - np.repeat(ends - c[many], c[many])
                crowded.append(np.stack([np.full(ends[-1], i), np.repeat(s[many], c[many]) + inner]))
        if keys:
            out.append(_compared(np.array(keys), np.zeros(len(keys), np.int64), docs, starts, marks, bodies))
        if crowded:
            row, start = np.unique(np.concatenate(crowded, axis=1), axis=1)
            out += _crowded(data, base, row, start, doc_ids[first:last], versions[first:last])
    return out


GONE = np.iinfo(np.int32).min


def _crowded(data, base, row, start, docs, versions) -> list[pa.RecordBatch]:
    """Sort the suffixes at hand; of equal strings only the earliest goes on, the others are done."""
    order, new = sort_suffixes(data, base[row] + start, N)
    number = np.cumsum(new) - 1
    row, start = row[order], start[order]
    by = np.lexsort((versions[row], start, docs[row], number))
    row, start, number = row[by], start[by], number[by]
    heads = np.searchsorted(number, np.arange(number[-1] + 1))
    head = heads[number]
    gone = (docs[row] != docs[row[head]]) | (start != start[head]) | (versions[row] != versions[row[head]])
    keep = np.zeros(len(row), bool)
    keep[heads] = True
    at = base[row] + start
    low, high = window_hashes(data, N)[0], window_hashes(data[::-1], N)[0][::-1]
    known = np.flatnonzero(gone)
    return [
        _compared(low[at[keep]].view(np.int64), high[at[keep]].view(np.int64), docs[row[keep]], start[keep], versions[row[keep]], None),
        _compared(mix(at[known].astype(np.uint64), docs[row[known]].view(np.uint64)).view(np.int64), np.zeros(len(known), np.int64),
                  docs[row[known]], -1 - start[known], versions[row[known]], None),
    ]


def _compared(key, second, docs, starts, versions, bodies) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(second), pa.array(np.asarray(docs, np.int64)), pa.array(np.asarray(starts, np.int32)),
         pa.array(np.asarray(versions, np.int32)), pa.array(bodies, pa.binary()) if bodies is not None else pa.nulls(n, pa.binary())],
        ["key", "second", "doc", "start", "version", "body"],
    )


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, second, doc, start) to the start ranges that go."""
    now = None  # first row of the string at hand, for rows without bytes
    held: list[pa.RecordBatch] = []  # blocks of whole minima, not sorted yet
    size = 0
    for batch in batches:
        body = batch.column("body")
        has = np.asarray(body.is_valid())
        if not has.all():
            plain = batch.filter(pa.array(~has))
            rows, now = _first_goes_not(plain, now)
            yield rows
        if has.any():
            blocks = batch.filter(pa.array(has))
            held.append(blocks)
            size += blocks.nbytes
            if size > SORT_STARTS * 2:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                key = whole.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))  # the last minimum may go on
                if cut:
                    yield from _sorted_blocks(whole.slice(0, cut))
                held, size = [whole.slice(cut)], 0
    if held:
        yield from _sorted_blocks(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    free_memory()


def _first_goes_not(batch: pa.RecordBatch, now):
    key, second, doc, start, version = (batch.column(c).to_numpy() for c in ("key", "second", "doc", "start", "version"))
    known = start < 0
    start = np.where(known, -1 - start, start).astype(np.int64)
    pack = _pack(start, np.ones(len(start), np.int64), version)
    k, s, d, p = key[~known], second[~known], doc[~known], pack[~known]
    gone = np.zeros(len(k), bool)
    if len(k):
        if now:
            k, s, d, p = (np.concatenate([[x], y]) for x, y in zip(now, (k, s, d, p), strict=True))
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        gone = (d != d[head]) | (p != p[head])
        now = tuple(int(x[head[-1]]) for x in (k, s, d, p))
        doc_gone, pack_gone = d[gone], p[gone]
    else:
        doc_gone, pack_gone = d, p
    docs, packs = np.concatenate([doc[known], doc_gone]), np.concatenate([pack[known], pack_gone])
    return _rows(pa.nulls(len(docs), pa.int64()), docs, packs), now


def _sorted_blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Suffixes of blocks in deep-shallow order, whole minima at a time; ranges of those that repeat an earlier one."""
    key = batch.column("key").to_numpy()
    ends = np.cumsum(pc.binary_length(batch.column("body")).to_numpy().astype(np.int64) - (N - 1))
    last = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    first = 0
    while first < len(key):
        base = ends[first - 1] if first else 0
        fit = last[(last > first) & (ends[last - 1] <= base + SORT_STARTS)]
        to = int(fit[-1]) if len(fit) else int(last[last > first][0])
        yield _repeats(batch.slice(first, to - first))
        first = to


def _repeats(batch: pa.RecordBatch) -> pa.RecordBatch:
    docs, starts, versions = (batch.column(c).to_numpy() for c in ("doc", "start", "version"))
    run = next(runs(batch.column("body"), target=1 << 62))
    count = run.lengths - (N - 1)
    row = np.repeat(np.arange(len(docs)), count)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    order, new = sort_suffixes(run.data, run.starts[row] + inner, N)
    number = np.cumsum(new) - 1
    string = np.empty(len(row), np.int64)
    string[order] = number
    start = starts[row] + inner
    sizes = np.bincount(number)
    shared = np.flatnonzero(sizes[string] > 1)
    by = shared[np.lexsort((versions[row[shared]], start[shared], docs[row[shared]], string[shared]))]
    if not len(by):
        return _rows(pa.nulls(0, pa.int64()), docs[:0], docs[:0])
    head = np.ones(len(by), bool)
    head[1:] = string[by][1:] != string[by][:-1]
    first = by[np.flatnonzero(head)[np.cumsum(head) - 1]]
    gone = by[(docs[row[by]] != docs[row[first]]) | (start[by] != start[first]) | (versions[row[by]] != versions[row[first]])]
    gone = np.sort(gone)  # starts in a row of one block become one range
    cut = np.ones(len(gone), bool)
    cut[1:] = (np.diff(gone) != 1) | (row[gone][1:] != row[gone][:-1])
    heads = np.flatnonzero(cut)
    size = np.diff(np.append(heads, len(gone)))
    at = gone[heads]
    return _rows(pa.nulls(len(at), pa.int64()), docs[row[at]], _pack(start[at], size, versions[row[at]]))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    out = []
    carried = [c for c in batch.schema.names if c.startswith("_")]
    lists, ids = batch.column("ranges"), batch.column("doc_id")
    for first, last in _pieces(batch, 1 << 20):
        texts = _texts(batch, first, last)
        removed, spans, digests, kept = [], [], [], []
        for i, text in enumerate(texts):
            part = lists[first + i].values
            n_gone = n_spans = 0
            if part is not None and len(part):
                start, count, _ = _unpack(part.to_numpy())
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, start, 1)
                np.add.at(change, start + count + N - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                n_gone = int(gone.sum())
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                text = np.frombuffer(text, np.uint8)[~gone].tobytes()
            removed.append(n_gone)
            spans.append(n_spans)
            digests.append(hashlib.sha256(text).hexdigest())
            kept.append(text)
        sizes = batch.column("n_bytes").slice(first, last - first)
        out.append(pa.RecordBatch.from_arrays(
            [ids.slice(first, last - first), sizes, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digests, pa.string()), pa.array(kept, pa.binary()), *(batch.column(c).slice(first, last - first) for c in carried)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *(c[1:] for c in carried)]))
    return out


def removed_ranges(keyed: DataFrame) -> DataFrame:
    """(doc, pack) of every range of starts whose strings also start earlier."""
    blocks = map_batches(keyed.select("doc", "version", "text"), _anchors, ANCHORS)
    met = blocks.repartition("h").sortWithinPartitions("h", "b", "doc", "pack").mapInArrow(_meet, RANGES)
    met = settle(met, "suffix-blocks")
    open_blocks = met.where("h is not null")
    many = open_blocks.groupBy("h").count().where(F.col("count") > MOST_BLOCKS).select("h", F.lit(True).alias("crowded"))
    open_blocks = open_blocks.join(many, "h", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    per_doc = open_blocks.groupBy("doc", F.col("pack").bitwiseAND(VERSION).cast("int").alias("version")).agg(
        F.collect_list(F.struct("h", "pack", "crowded")).alias("blocks")
    )
    texts = map_batches(keyed, _compress([]), PACKED).drop("doc_id")
    compared = map_batches(texts.join(per_doc, ["doc", "version"]), _spread_starts, COMPARED)
    decided = compared.repartition("key").sortWithinPartitions("key", "second", "doc", "start").mapInArrow(_decide, RANGES)
    return met.where("h is null").select("doc", "pack").unionByName(settle(decided, "suffix-repeats").select("doc", "pack"))


def remove_repeats(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, the remaining bytes ``kept``, and string columns to carry along."""
    carry = carry or []
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST)).alias("doc"),
        F.hash(text_or_empty()).bitwiseAND(VERSION).alias("version"),
        text_or_empty().cast("binary").alias("text"),
        *(F.col(c).cast("string").alias(f"_{c}") for c in carry),
    )
    ranges = removed_ranges(keyed.drop(*(f"_{c}" for c in carry))).groupBy("doc", F.col("pack").bitwiseAND(VERSION).cast("int").alias("version")).agg(
        F.collect_list("pack").alias("ranges")
    )
    texts = map_batches(keyed, _compress(carry), ", ".join([PACKED, *(f"_{c} string" for c in carry)]))
    schema = ", ".join([RESULT, *(f"{c} string" for c in carry)])
    return map_batches(texts.join(ranges, ["doc", "version"], "left"), _remove, schema)
