"""Learning from every labelled text: shards of texts, a learner each, and averages of what they learned.

The labelled texts are dealt to shards of about ``SHARD_ROWS`` rows by the hash of their id. In a round each shard starts from
the same parameters and goes through its texts, a batch at a time; Spark then averages, block by
block, how far the shards moved each parameter, over those that moved it, weighted by their rows. So an embedding
that few shards use keeps what they learned. No text and no shard passes through the driver, only the parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import BATCH_KEY, BATCH_ROWS, free_memory, map_batches, pack_texts, text_or_empty, unpack_texts
from newslake.session import DENSE, settle

SHARD_ROWS = 1 << 15
BLOCK = 1 << 13  # parameters averaged together

State = dict[str, np.ndarray]
PACKED = "shard int, place long, doc_id long, size long, packed binary"
SHARDED = "shard int, doc_id long, label int, size long, packed binary"
MOVED = "block int, shard int, weight double, change binary, moved binary"


def _pack(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    out = [batch.column(c) for c in ("shard", "place", "doc_id")]
    return [pa.RecordBatch.from_arrays([*out, *pack_texts(batch.column("text"))], ["shard", "place", "doc_id", "size", "packed"])]


def _meet(texts: pa.Table, labels: pa.Table) -> pa.Table:
    """Texts of a shard with their labels, in the order of their hashes."""
    labels = labels.sort_by("doc_id")
    ids = labels.column("doc_id").to_numpy()
    mine = texts.column("doc_id").to_numpy()
    at = np.searchsorted(ids, mine)
    found = np.zeros(len(mine), bool)
    if len(ids):
        found = ids[np.minimum(at, len(ids) - 1)] == mine
    rows = np.flatnonzero(found)
    texts = texts.take(pa.array(rows)).append_column("label", labels.column("label").take(pa.array(at[rows])))
    return texts.sort_by([("place", "ascending"), ("doc_id", "ascending")]).select(["shard", "doc_id", "label", "size", "packed"])


def labelled_shards(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Every row of ``docs`` whose id has a label, whole: shard, doc_id, label, and the text compressed.

    ``labels`` holds doc_id and the label, one row per id. Only their number sets the number of shards, so a rerun elsewhere learns the same.
    """
    labels = settle(labels.select("doc_id", F.col(label).cast("int").alias("label")), "labelled")
    n = -(-labels.count() // SHARD_ROWS) or 1
    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(n)).cast("int").alias("shard")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.select(shard, F.xxhash64("doc_id", "text").alias("place"), "doc_id", "text")
    texts = map_batches(texts, _pack, PACKED).groupBy("shard")
    return settle(texts.cogroup(labels.select(shard, "doc_id", "label").groupBy("shard")).applyInArrow(_meet, SHARDED), "shards", DENSE)


def texts_of(batch: pa.RecordBatch) -> pa.Array:
    return pa.array(unpack_texts(batch.column("size"), batch.column("packed")), pa.large_binary())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut where the shard changes."""
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
        yield from ((int(shard[a]), batch.slice(a, b - a)) for a, b in zip(cuts, cuts[1:], strict=False) if a < b)


def _flat(state: State) -> np.ndarray:
    return np.concatenate([v.ravel() for v in state.values()]).astype(np.float32)


def _shaped(flat: np.ndarray, like: State) -> State:
    ends = np.cumsum([v.size for v in like.values()])
    return {k: flat[e - v.size : e].reshape(v.shape).copy() for e, (k, v) in zip(ends, like.items(), strict=True)}


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, shard) to one row a block: the mean change of each parameter over the shards that moved it."""
    now, total, weight = None, None, None

    def done() -> pa.RecordBatch:
        mean = np.divide(total, weight, out=np.zeros_like(total), where=weight > 0).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["block", "change"])

    for batch in batches:
        for block, w, change, moved in zip(*(batch.column(c).to_pylist() for c in ("block", "weight", "change", "moved")), strict=True):
            change = np.frombuffer(change, np.float32)
            if block != now:
                if now is not None:
                    yield done()
                now, total, weight = block, np.zeros(len(change)), np.zeros(len(change))
            total += w * change
            weight += w * np.unpackbits(np.frombuffer(moved, np.uint8), count=len(change))
    if now is not None:
        yield done()
    free_memory()


def learn(rows: DataFrame, state: State, learner: Callable[[State, int], object], rounds: int,
          read: Callable[[pa.RecordBatch], object] = texts_of) -> State:
    """Parameters after some rounds over all rows of ``labelled_shards``, or of a table with shard and label of which ``read`` gives what is learned from.

    ``learner(state, seed)`` makes an object whose ``add(texts, labels)`` learns from a batch and whose ``state()`` gives its
    parameters, named and shaped as in ``state``, as 32-bit floats.
    """
    conf = rows.sparkSession.conf
    if int(conf.get(BATCH_KEY, "10000")) > BATCH_ROWS:
        conf.set(BATCH_KEY, str(BATCH_ROWS))
    for r in range(rounds):
        # The parameters go out once an executor, not once a task.
        start = rows.sparkSession.sparkContext.broadcast(state)

        def each(batches: Iterator[pa.RecordBatch], r: int = r, start=start) -> Iterator[pa.RecordBatch]:
            for shard, parts in groupby(_parts(batches), key=lambda x: x[0]):
                before = _flat(start.value)
                mine, weight = learner(_shaped(before, start.value), 1000 * r + shard), 0
                for _, part in parts:
                    mine.add(read(part), part.column("label").to_numpy())
                    weight += part.num_rows
                change = _flat(mine.state()) - before
                for b in range(0, len(change), BLOCK):
                    piece = change[b : b + BLOCK]
                    if piece.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([b // BLOCK], pa.int32()), pa.array([shard], pa.int32()), pa.array([float(weight)]),
                             pa.array([piece.tobytes()], pa.binary()), pa.array([np.packbits(piece != 0).tobytes()], pa.binary())],
                            ["block", "shard", "weight", "change", "moved"])
            free_memory()

        moved = rows.mapInArrow(each, MOVED).repartition("block").sortWithinPartitions("block", "shard", "weight")
        flat = _flat(state)
        for got in moved.mapInArrow(_average, "block int, change binary").toArrow().to_pylist():
            change = np.frombuffer(got["change"], np.float32)
            flat[got["block"] * BLOCK :][: len(change)] += change
        state = _shaped(flat, state)
        start.unpersist()
    return state
