"""Near-duplicate documents by MinHash bands, odd sketches and full sets.

A document's set holds the hashes of its four-word shingles. A signature of ``BANDS`` x ``ROWS``
minima puts documents into buckets; ``ROWS`` is high enough that documents that share only a passage
rarely meet, and a pair at the threshold misses all buckets with probability
``(1 - 0.8 ** ROWS) ** BANDS`` (about 3 in a million), a closer pair far more rarely. The same minima are folded into an odd
sketch: each one flips a bit, so the population count of the XOR of two sketches tells how many
minima differ. Pairs whose estimate lies more than six standard errors below the threshold are
dropped; all others are confirmed on the full sets. A second sketch of the same width holds the parity of the whole
set. Each shingle that only one of two sets has flips one bit, so the XOR's population count never exceeds the
symmetric difference, and a pair with more bits than a link allows is ruled out for certain. (Sets of several thousand shingles
fill the map; for them the samples decide.)

* Documents with equal sets are one class, with the smallest id as its representative; only
  representatives meet in buckets, so copies cost nothing further.
* In a bucket, only two members are compared with all others: the smallest, and the most central one (that with
  most company over all its buckets; the text that near copies were made from is met by more of them than they meet
  each other). Members that are then in another component than both are compared with every member outside their own
  component, so no link between components is lost. The join that pairs them lets only pairs out whose sketches are plausible
  and whose shared shingles can suffice: a shingle that no other such member has is in no intersection, so a heavily
  edited copy is ruled out against a whole group at once.
* Components: smallest id by propagation with pointer jumping, as tables in the shared folder.

Null or wordless text has an empty set, is linked with nothing and kept. A row with a null id is
linked with nothing, has a null component and is kept. Rows that repeat an id are one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import has_bit, id_bits, id_place, map_batches, pack_texts, text_or_empty, unpack_texts
from newslake.llm.textbytes import M1, mix, runs, words
from newslake.session import settle

SHINGLE = 4
PERCENT = 80
ROWS, BANDS = 5, 32
SAMPLES = ROWS * BANDS
SKETCH_BITS = 1024
_RNG = np.random.default_rng(77)
_FLIP = _RNG.integers(0, 2**64, SAMPLES, dtype=np.uint64)
_FACTOR = _RNG.integers(0, 2**64, SAMPLES, dtype=np.uint64) | np.uint64(1)


def shingles(run, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document of a run, sorted, and where each document's begin."""
    start, _, hashed = words(run, lower=True)
    owner = run.owners(start)
    n = len(run.lengths)
    count = np.bincount(owner, minlength=n)
    value = hashed
    parts = [hashed]
    for i in range(1, size):
        parts.append(np.concatenate([hashed[i:], np.zeros(min(i, len(hashed)), np.uint64)]))
    value = parts[0]
    for i in range(1, size):
        value = mix(value, parts[i])
    first = np.cumsum(count) - count
    inner = np.arange(len(start)) - first[owner]
    whole = inner + size <= count[owner]
    for d in np.flatnonzero((count > 0) & (count < size)):
        h = hashed[first[d]]
        for i in range(1, count[d]):
            h = mix(np.array([h]), hashed[first[d] + i : first[d] + i + 1])[0]
        whole[first[d]] = True
        value[first[d]] = mix(np.array([h]), np.array([count[d]], np.uint64))[0]
    value, owner = value[whole], owner[whole]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(n + 1))


def signatures(value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima for each document that has a shingle."""
    heads = begins[:-1][np.diff(begins) > 0]
    out = np.empty((len(heads), SAMPLES), np.uint64)
    if not len(heads):
        return out
    step = np.empty_like(value)
    for j in range(SAMPLES):
        np.bitwise_xor(value, _FLIP[j], out=step)
        np.multiply(step, _FACTOR[j], out=step)
        out[:, j] = np.minimum.reduceat(step, heads)
    return out


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Bit maps of ``SKETCH_BITS`` bits, one per row: the parity of the samples that fall on each bit."""
    sample = np.arange(SAMPLES, dtype=np.uint64)[None, :] * M1
    bit = (mix(minima, np.broadcast_to(sample, minima.shape)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flat = np.bincount((np.arange(len(minima))[:, None] * SKETCH_BITS + bit).ravel(), minlength=len(minima) * SKETCH_BITS)
    return np.packbits((flat & 1).astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1)


def set_sketches(value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bit maps of ``SKETCH_BITS`` bits, one per document that has a shingle: the parity of its whole set on each bit."""
    size = np.diff(begins)
    owner = np.repeat(np.arange(np.count_nonzero(size)), size[size > 0])
    flat = np.zeros((np.count_nonzero(size), SKETCH_BITS), np.uint8)
    np.bitwise_xor.at(flat, (owner, (mix(value, value ^ M1) % np.uint64(SKETCH_BITS)).astype(np.int64)), np.uint8(1))
    return np.packbits(flat, axis=1)


def estimate(differing_bits: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the population count of two sketches' XOR."""
    full = np.minimum(2 * differing_bits / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS * np.log1p(-full) / (4 * SAMPLES)


def _least_plausible() -> float:
    """Six standard errors of the samples and of the sketch below the threshold."""
    j = PERCENT / 100
    flips = 2 * SAMPLES * (1 - j)
    p = (1 - np.exp(-2 * flips / SKETCH_BITS)) / 2
    sketch = np.sqrt(SKETCH_BITS * p * (1 - p)) / (2 * SAMPLES * (1 - 2 * p))
    return float(j - 6 * np.hypot(np.sqrt(j * (1 - j) / SAMPLES), sketch))


FEATURES = "doc_id long, n_shingles long, low long, high long, bands array<long>, sketch array<long>, whole array<long>"


def _features(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    out = []
    for run in runs(batch.column("text")):
        value, begins = shingles(run, SHINGLE)
        size = np.diff(begins)
        some = size > 0
        heads = begins[:-1][some]
        low, high = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
        bands, sketch, whole = [None] * len(size), [None] * len(size), [None] * len(size)
        if some.any():
            low[some] = np.add.reduceat(mix(value, value), heads)
            high[some] = np.add.reduceat(mix(value * M1, ~value), heads)
            minima = signatures(value, begins)
            keys = np.empty((len(minima), BANDS), np.uint64)
            for band in range(BANDS):
                key = np.full(len(minima), band, np.uint64) * M1
                for row in range(ROWS):
                    key = mix(key, minima[:, band * ROWS + row])
                keys[:, band] = key
            for i, k, s, w in zip(np.flatnonzero(some), keys.view(np.int64), odd_sketches(minima), set_sketches(value, begins), strict=True):
                bands[i], sketch[i], whole[i] = k, s.view(np.int64), w.view(np.int64)
        out.append(pa.RecordBatch.from_arrays(
            [batch.column("doc_id").slice(run.first, len(size)), pa.array(size, pa.int64()), pa.array(low.view(np.int64)),
             pa.array(high.view(np.int64)), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64())),
             pa.array(whole, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "low", "high", "bands", "sketch", "whole"]))
    return out


PACKED = "doc_id long, size long, packed binary"
SETS = "doc_id long, members array<long>"


def _pack(bits):
    """Texts compressed, of documents whose bit is set."""

    def f(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        batch = batch.filter(has_bit(bits.value, batch.column("place")))
        sizes, packed = pack_texts(batch.column("text"))
        return [pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, packed], ["doc_id", "size", "packed"])]

    return f


def _sets(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    out = []
    for run in runs(pa.array(unpack_texts(batch.column("size"), batch.column("packed")), pa.binary())):
        value, begins = shingles(run, SHINGLE)
        members = pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(value.view(np.int64))).cast(pa.list_(pa.int64()))
        out.append(pa.RecordBatch.from_arrays([batch.column("doc_id").slice(run.first, len(members)), members], ["doc_id", "members"]))
    return out


def _confirm(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    keep = []
    for x, y in zip(batch.column("members_a"), batch.column("members_b"), strict=True):
        x, y = x.values.to_numpy(), y.values.to_numpy()
        both = len(np.intersect1d(x, y, assume_unique=True))
        keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    return [batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))]


LEAST = _least_plausible()
WORDS = SKETCH_BITS // 64
# Most differing bits of two sketches whose estimate is still plausible.
MOST_BITS = int(np.flatnonzero(estimate(np.arange(SKETCH_BITS // 2)) >= LEAST).max())


def _differing(x: str, y: str, prefix: str) -> Column:
    return sum((F.bit_count(F.col(f"{x}.{prefix}{i}").bitwiseXOR(F.col(f"{y}.{prefix}{i}"))) for i in range(WORDS)), F.lit(0))


def _plausible(x: str, y: str) -> Column:
    """The sizes and the sketches of two sides do not rule the threshold out."""
    size = [F.col(f"{side}.n_shingles") for side in (x, y)]
    # Linked sets of n and m shingles differ in d of them with PERCENT * (n + m + d) <= 100 * (n + m - d).
    may_differ = (100 + PERCENT) * _differing(x, y, "w") <= (100 - PERCENT) * (size[0] + size[1])
    return (100 * F.least(*size) >= PERCENT * F.greatest(*size)) & may_differ & (_differing(x, y, "s") <= MOST_BITS)


def _likely(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) that their sketches let pass."""
    heads = heads.drop("bands")
    one = pairs.distinct().join(heads.withColumnRenamed("doc_id", "a"), "a").alias("x")
    return one.join(heads.withColumnRenamed("doc_id", "b").alias("y"), (F.col("x.b") == F.col("y.b")) & _plausible("x", "y")).select("x.a", "x.b")


def _member_sets(ids: DataFrame, docs: DataFrame, hint: str | None = None) -> DataFrame:
    """(doc_id, members) of the given ids. Texts travel compressed, and of other documents only those that share a bit with a given id."""
    ids = settle(ids, "near-wanted")
    texts = map_batches(docs.select("doc_id", id_place().alias("place"), text_or_empty().alias("text")), _pack(id_bits(ids)), PACKED)
    return settle(map_batches(texts.join(ids.hint(hint) if hint else ids, "doc_id", "left_semi"), _sets, SETS), "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs confirmed on full sets."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("members").alias(f"members_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return map_batches(joined, _confirm, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every document with a link; component_id is the smallest id reachable."""
    both = settle(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "near-links")
    state = settle(both.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("c"))
                   .select("doc_id", F.least("doc_id", "c").alias("component_id")), "near-components")
    while True:
        around = both.join(state.withColumnRenamed("doc_id", "b"), "b").groupBy(F.col("a").alias("doc_id")).agg(
            F.min("component_id").alias("c"))
        step = state.join(around, "doc_id").select("doc_id", "component_id", F.least("component_id", "c").alias("c"))
        root = state.select(F.col("doc_id").alias("c"), F.col("component_id").alias("r"))
        jumped = settle(step.join(root, "c").select(
            "doc_id", F.least("c", "r").alias("component_id"), (F.least("c", "r") < F.col("component_id")).alias("moved")), "near-components")
        state = jumped.select("doc_id", "component_id")
        if not jumped.where("moved").take(1):
            return state


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = settle(map_batches(docs.select("doc_id", text_or_empty().alias("text")), _features, FEATURES), "near-features")
    filled = features.where("doc_id is not null and n_shingles > 0")
    classes = settle(filled.groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("head")), "near-classes")
    heads = settle(filled.join(classes.select(F.col("head").alias("doc_id")), "doc_id", "left_semi")
                   .dropDuplicates(["doc_id"]), "near-heads")
    rows = heads.select(F.explode("bands").alias("bucket"), "doc_id")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1")
    shared = settle(rows.join(sizes, "bucket"), "near-shared")
    company = shared.groupBy("doc_id").agg(F.sum("n").alias("company"))
    central = shared.join(company, "doc_id").groupBy("bucket").agg(F.max(F.struct("company", "doc_id"))["doc_id"].alias("most"))
    buckets = settle(shared.drop("n").join(central, "bucket"), "near-buckets")
    ordered = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    first = buckets.select("doc_id", F.explode(F.array("least", "most")).alias("y")).where("doc_id <> y").withColumnRenamed("doc_id", "x").select(*ordered)
    small = heads.select("doc_id", "n_shingles", "bands", *(F.col(c)[i].alias(f"{c[0]}{i}") for c in ("sketch", "whole") for i in range(WORDS)))
    likely = settle(_likely(first, small), "near-likely")
    # The ids wanted grow with the documents: a plan that does not count on broadcasting them.
    wanted = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    links = settle(_confirmed(likely, _member_sets(wanted, docs, "merge")), "near-confirmed")
    state = components(links)
    # What is left: members outside the components of both of their bucket's leaders, and leaders' components not yet linked.
    of = lambda x, y: state.select(F.col("doc_id").alias(x), F.col("component_id").alias(y))
    placed = buckets.join(of("doc_id", "own"), "doc_id", "left").join(of("least", "low"), "least", "left").join(of("most", "top"), "most", "left").select(
        "bucket", "doc_id", *(F.coalesce(c, d).alias(c) for c, d in (("own", "doc_id"), ("low", "least"), ("top", "most"))))
    # Leaders have met every member, so they need no partner here.
    placed = placed.join(buckets.select("bucket", "least", "most").distinct(), "bucket").where("doc_id <> least and doc_id <> most").drop("least", "most")
    placed = settle(placed, "near-placed")
    mixed = placed.where("own <> low or low <> top").select("bucket").distinct()
    placed = settle(placed.join(mixed, "bucket", "left_semi"), "near-mixed")
    sets = _member_sets(placed.select("doc_id").distinct(), docs)
    owners = sets.select("doc_id", F.explode("members").alias("member")).groupBy("member").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    alone = owners.where("n = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    placed = placed.join(small, "doc_id").join(alone, "doc_id", "left").withColumn("common", F.col("n_shingles") - F.coalesce("alone", F.lit(0)))
    placed = settle(placed.drop("alone"), "near-measured")
    common = F.least("x.common", "y.common")
    # A pair comes out of the first bucket it shares, not of every one. Where it met a leader there, it is compared already.
    once = F.get(F.array_intersect("x.bands", "y.bands"), 0) == F.col("x.bucket")
    enough = 100 * common >= PERCENT * (F.col("x.n_shingles") + F.col("y.n_shingles") - common)
    loose = placed.where("own <> low and own <> top").alias("x")
    rest = loose.join(placed.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.own") != F.col("y.own")) & enough & _plausible("x", "y") & once)
    split = placed.where("low <> top")
    across = split.where("own = low").alias("x").join(
        split.where("own = top").alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & enough & _plausible("x", "y") & once)
    more = rest.select(F.col("x.doc_id").alias("x"), F.col("y.doc_id").alias("y")).union(
        across.select(F.col("x.doc_id").alias("x"), F.col("y.doc_id").alias("y"))).select(*ordered).distinct()
    more = settle(more, "near-likely")
    if more.take(1):
        state = components(links.union(settle(_confirmed(more, sets), "near-confirmed")))
    member = filled.select("doc_id", "low", "high", "n_shingles").join(classes, ["low", "high", "n_shingles"]).select("doc_id", "head").distinct()
    member = member.join(of("head", "component"), "head", "left").select("doc_id", F.coalesce("component", "head").alias("component"))
    # An id that occurs with several texts belongs to the smallest of their components.
    member = member.groupBy("doc_id").agg(F.min("component").alias("component"))
    result = features.select("doc_id", "n_shingles").join(member, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
