"""Language identification in two steps: the family first, then the language within it.

Features are hashed byte trigrams of the whole lower-cased text, as shares of all its trigrams. Both
steps are one-versus-one linear support vector machines (squared hinge loss): between each two families, and
between each two languages of a family. A text goes to the family with most wins (ties: the
larger sum of margins, then the name), then likewise to a language. A linear score over shares is a
mean over positions, so a text of any length is scored in one pass without a feature vector.

Learned from every row with an id, a text and a language outside the held-out fold: the numbers of their trigrams are dealt to shards by the hash
of the id, and all machines learn from them shard by shard (``shards.learn``). A language too rare for each shard to get ``LEAST`` of
its rows has rows in several shards; both sides of a machine weigh the same.
Families are a parameter; a language without one is a family of its own.

Null text and text without a letter are ``und`` with score 0, and so is all text if there is
nothing to learn from. The score is the product of the two steps' confidences (logistic of the smallest margin
of the winner), between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.llm import shards
from newslake.llm.common import fold, free_memory, map_batches, text_or_empty
from newslake.llm.textbytes import LOWER, Run, runs
from newslake.session import released, settle

FOLDS, HELD_OUT = 4, 2
ROUNDS, PASSES = 2, 4  # rounds over all shards, and times that a round goes through each row, however many there are
FEW = 32  # rows of an update
LEAST = 400  # rows of a language that a shard gets on average, if there are as many
RATE, SLOWER = 0.02, 50  # step length at first, and updates after which it has fallen by a third
RIDGE = np.float32(1e-4)
UNITS = 1 << 36  # of a share, to add shares up exactly
BUCKETS = 4096
UNKNOWN = "und"
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "sl", "uk"),
}


def trigrams(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram at each byte of a run, and each text's first and end index among them."""
    data = LOWER[run.data].astype(np.uint32)
    if len(data) < 3:
        key = np.zeros(0, np.int64)
    else:
        key = ((data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))) * np.uint32(2654435761)) >> np.uint32(20)
    first = run.starts[:-1]
    return key, np.minimum(first, len(key)), np.minimum(np.maximum(run.starts[1:] - 2, first), len(key))


@dataclass
class Machine:
    """Decides between two classes: positive margins for ``left``."""

    left: str
    right: str
    weights: np.ndarray
    bias: float


@dataclass
class Step:
    classes: list[str]
    machines: list[Machine]

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winning class number and confidence from one column of margins per machine."""
        n = len(margins)
        at = {c: i for i, c in enumerate(self.classes)}
        wins, total = np.zeros((n, len(at))), np.zeros((n, len(at)))
        least = np.full((n, len(at)), np.inf)
        for j, m in enumerate(self.machines):
            for side, sign in ((at[m.left], 1), (at[m.right], -1)):
                wins[:, side] += sign * margins[:, j] > 0
                total[:, side] += np.tanh(sign * margins[:, j])
                least[:, side] = np.minimum(least[:, side], sign * margins[:, j])
        best = (wins + total / (2 * len(self.machines) + 2)).argmax(axis=1)
        margin = np.where(np.isinf(least), 20.0, least)[np.arange(n), best]
        return best, 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))


@dataclass
class LanguageModel:
    families: Step
    languages: dict[str, Step]

    def margins(self, run: Run, step: Step) -> np.ndarray:
        key, first, end = trigrams(run)
        out = np.empty((len(first), len(step.machines)))
        for j, m in enumerate(step.machines):
            sums = np.zeros(len(key) + 1)
            np.cumsum(m.weights[key], out=sums[1:], dtype=np.float64)
            out[:, j] = (sums[end] - sums[first]) / np.maximum(end - first, 1) + m.bias
        return out

    def predict(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        family, score = self.families.decide(self.margins(run, self.families))
        names = np.empty(len(family), object)
        for number, name in enumerate(self.families.classes):
            mine = np.flatnonzero(family == number)
            if len(mine):
                step = self.languages[name]
                best, confidence = step.decide(self.margins(run, step)[mine])
                names[mine] = np.array(step.classes, object)[best]
                score[mine] *= confidence
        return names, score


def _family_of(lang: str) -> str:
    return next((family for family, members in FAMILIES.items() if lang in members), lang)


@dataclass
class Duels:
    """All machines of both steps as columns: who meets, and by language its side (1, -1, or 0 where it is not in the duel) and the weight of its rows."""

    names: list[str]
    pairs: list[tuple[str, str, str]]  # the family whose step it is, "" for the families' step, and both classes
    side: np.ndarray
    weight: np.ndarray
    scale: np.ndarray  # of a share, by bucket and machine

    @classmethod
    def of(cls, names: list[str]) -> Duels:
        family = [_family_of(n) for n in names]
        classes = [("", sorted(set(family)))] + [(f, [n for n, g in zip(names, family, strict=True) if g == f]) for f in sorted(set(family))]
        pairs = [(step, left, right) for step, members in classes for left, right in combinations(members, 2)]
        side = np.zeros((len(names), len(pairs)), np.float32)
        for j, (step, left, right) in enumerate(pairs):
            for i in range(len(names)):
                mine = names[i] if step else family[i]
                side[i, j] = (mine == left) - (mine == right)
        return cls(names, pairs, side, np.zeros_like(side), np.ones((BUCKETS, len(pairs)), np.float32))

    def weigh(self, count: np.ndarray, shares: np.ndarray) -> None:
        """Both sides of a machine weigh the same, and its features have like sizes; from the rows and the sums of shares by language."""
        inside = np.abs(self.side)
        rows = count @ inside
        of_side = np.where(self.side > 0, count @ (self.side > 0), count @ (self.side < 0))
        self.weight = (inside * rows / (2 * np.maximum(of_side, 1))).astype(np.float32)
        self.scale = (1 / np.sqrt(shares.T @ inside / np.maximum(rows, 1) + 1e-5)).astype(np.float32)

    def model(self, weights: np.ndarray, bias: np.ndarray) -> LanguageModel:
        weights = weights * self.scale
        steps: dict[str, Step] = {f: Step([n for n in self.names if _family_of(n) == f], []) for f in sorted({_family_of(n) for n in self.names})}
        families = Step(list(steps), [])
        for j, (step, left, right) in enumerate(self.pairs):
            (steps[step] if step else families).machines.append(Machine(left, right, np.ascontiguousarray(weights[:, j]), float(bias[j])))
        return LanguageModel(families, steps)


class Learner:
    """All machines on one shard: squared hinge loss with a small ridge, by Adam with falling steps; see ``shards.learn``."""

    def __init__(self, duels: Duels, state: shards.State | None, seed: int):
        self.duels, self.r = duels, np.random.default_rng(seed)
        n = len(duels.pairs)
        self.p = {"weights": np.zeros((BUCKETS, n), np.float32), "bias": np.zeros(n, np.float32)}
        self.m, self.v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in "mv")
        self.t = np.zeros(1, np.float32)
        for k, v in (state or {}).items():
            self.state()[k][...] = v

    def state(self) -> shards.State:
        return self.p | {"t": self.t} | {f"m.{k}": v for k, v in self.m.items()} | {f"v.{k}": v for k, v in self.v.items()}

    def add(self, shares: np.ndarray, labels: np.ndarray) -> None:
        for _ in range(PASSES):
            order = self.r.permutation(len(labels))
            for i in range(0, len(order), FEW):
                self._step(shares[order[i : i + FEW]], labels[order[i : i + FEW]])

    def _step(self, x: np.ndarray, labels: np.ndarray) -> None:
        d, p = self.duels, self.p
        side = d.side[labels]
        slack = np.maximum(0, 1 - side * (x @ (p["weights"] * d.scale) + p["bias"]))
        slope = -2 * d.weight[labels] * side * slack / len(labels)
        grads = {"weights": x.T @ slope * d.scale + RIDGE * p["weights"], "bias": slope.sum(axis=0) + RIDGE * p["bias"]}
        self.t += 1
        t = float(self.t[0])
        rate = np.float32(RATE / np.sqrt(1 + t / SLOWER) / (1 - 0.9**t))
        spread = np.float32(1 / np.sqrt(1 - 0.999**t))
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            g *= g
            g *= np.float32(0.001)
            v *= np.float32(0.999)
            v += g
            root = np.sqrt(v, out=g)
            root *= spread
            root += np.float32(1e-8)
            p[k] -= np.divide(m, root, out=root) * rate


DEALT = "shard int, place long, doc_id long, label int, size int, packed binary"
MOST = 255  # of a byte


def _counted(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct buckets and their numbers as pairs of bytes, the step from the bucket before and a number, and how many pairs a text has.

    A longer step has pairs of number 0 before it, a larger number has pairs of step 0 behind it.
    """
    key, first, end = trigrams(run)
    number = np.concatenate([np.bincount(key[a:b], minlength=BUCKETS) for a, b in zip(first, end, strict=True)])
    cell = np.flatnonzero(number)
    number = number[cell]
    owner, bucket = cell // BUCKETS, cell % BUCKETS
    step = np.diff(bucket, prepend=0)
    heads = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
    step[heads] = bucket[heads]
    before, behind = np.maximum(step - 1, 0) // MOST, (number - 1) // MOST
    times = before + 1 + behind
    at = np.cumsum(times) - times + before  # of the pair with both
    steps, numbers = np.full(int(times.sum()), MOST, np.uint8), np.zeros(int(times.sum()), np.uint8)
    turn = np.arange(len(steps)) - np.repeat(at, times)
    steps[turn > 0] = 0
    steps[at] = step - before * MOST
    numbers[turn > 0] = MOST
    numbers[at] = number - behind * MOST
    return steps, numbers, np.bincount(owner, times, len(first)).astype(np.int64)


def _dealer(names: list[str], copies: list[int], n: int) -> Callable[[pa.RecordBatch], list[pa.RecordBatch]]:
    """A row for each shard that a text is in, with the numbers of its trigrams, compressed."""
    number = {name: i for i, name in enumerate(names)}

    def f(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        label = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int32)
        size, packed = [], []
        for run in runs(batch.column("text")):
            steps, numbers, pairs = _counted(run)
            ends = np.cumsum(pairs).tolist()
            for n_pairs, end in zip(pairs.tolist(), ends, strict=True):
                size.append(n_pairs)
                packed.append(codec.compress(steps[end - n_pairs : end].tobytes() + numbers[end - n_pairs : end].tobytes(), asbytes=True) if n_pairs else b"")
        times = np.array(copies, np.int64)[label]
        rows = np.repeat(np.arange(len(label)), times)
        turn = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
        shard = (batch.column("base").to_numpy()[rows] + turn * (n // times[rows])) % n
        at = pa.array(rows)
        return [pa.RecordBatch.from_arrays(
            [pa.array(shard.astype(np.int32)), batch.column("place").take(at), batch.column("doc_id").take(at), pa.array(label[rows]),
             pa.array(size, pa.int32()).take(at), pa.array(packed, pa.binary()).take(at)],
            ["shard", "place", "doc_id", "label", "size", "packed"])]

    return f


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each pair of a batch as one number, and its share of the row's trigrams."""
    codec = pa.Codec("zstd")
    size = batch.column("size").to_numpy().astype(np.int64)
    packed = [codec.decompress(p.as_buffer(), decompressed_size=2 * n, asbytes=True) if n else b"" for n, p in zip(size.tolist(), batch.column("packed"), strict=True)]
    pairs = np.frombuffer(b"".join(packed), np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(row)) + (np.cumsum(size) - size)[row]  # the steps of a row come before its numbers
    total = np.cumsum(pairs[at], dtype=np.int64)
    number = pairs[at + size[row]].astype(np.float64)
    before = np.append(0, total)[np.cumsum(size) - size]
    return row * BUCKETS + total - before[row], number / np.bincount(row, number, len(size))[row]


def shares_of(batch: pa.RecordBatch) -> np.ndarray:
    """One row of trigram shares per text."""
    cell, share = _cells(batch)
    return np.bincount(cell, share, batch.num_rows * BUCKETS).astype(np.float32).reshape(-1, BUCKETS)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By language and bucket the sum of shares in a task's rows, in whole ``UNITS``; bucket ``BUCKETS`` counts the rows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        labels = batch.column("label").to_numpy()
        cell, share = _cells(batch)
        units, owner = np.floor(share * UNITS), labels[cell // BUCKETS]
        for label in np.unique(labels):
            mine = total.setdefault(int(label), np.zeros(BUCKETS + 1, np.int64))
            rows = owner == label
            mine[:BUCKETS] += np.bincount(cell[rows] % BUCKETS, units[rows], BUCKETS).astype(np.int64)
            mine[BUCKETS] += (labels == label).sum()
    for label, sums in total.items():
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), label, np.int32)), pa.array(some.astype(np.int32)), pa.array(sums[some])],
                                         ["label", "bucket", "total"])
    free_memory()


def fit(docs: DataFrame) -> LanguageModel | None:
    """Learn from all rows outside the held-out fold; None without any.

    The driver sees sums by language and the machines' weights, no text and nothing of a single row.
    """
    known = docs.where("doc_id is not null and lang is not null and text is not null").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(counts)
    duels = Duels.of(names)
    if not duels.pairs:
        return duels.model(np.zeros((BUCKETS, 0)), np.zeros(0)) if names else None
    n = -(-sum(counts.values()) // shards.SHARD_ROWS)
    copies = [min(n, -(-LEAST * n // counts[name])) for name in names]
    doc_id = F.col("doc_id").cast("long")
    texts = known.select(F.pmod(F.xxhash64(F.lit("shard"), doc_id), F.lit(n)).alias("base"), F.xxhash64(doc_id, "text").alias("place"),
                         doc_id.alias("doc_id"), "lang", "text")
    with released(docs.sparkSession):
        # More partitions than shards, so that few partitions hold two.
        dealt = map_batches(texts, _dealer(names, copies, n), DEALT).repartition(4 * n, "shard").sortWithinPartitions("shard", "place", "doc_id", "label")
        rows = settle(dealt, "trigrams")
        sums = rows.mapInArrow(_sums, "label int, bucket int, total long").groupBy("label", "bucket").agg(F.sum("total").alias("total")).toArrow()
        total = np.zeros((len(names), BUCKETS + 1))
        total[sums.column("label").to_numpy(), sums.column("bucket").to_numpy()] = sums.column("total").to_numpy()
        duels.weigh(total[:, BUCKETS], total[:, :BUCKETS] / UNITS)
        state = shards.learn(rows, Learner(duels, None, 0).state(), lambda state, seed: Learner(duels, state, seed), ROUNDS, shares_of)
    return duels.model(state["weights"], state["bias"])


def labelled(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` added (replacing columns of these names)."""
    rows = docs.drop("lang_pred", "score", "_letters").withColumn("_letters", text_or_empty().rlike(r"\p{L}"))
    names = docs.drop("lang_pred", "score", "_letters").columns

    def label(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        letters = batch.column("_letters").to_numpy(zero_copy_only=False)
        for run in runs(batch.column("text")):
            n = run.last - run.first
            found, score = (np.full(n, UNKNOWN, object), np.zeros(n)) if model is None else model.predict(run)
            found = np.where(letters[run.first : run.last], found, UNKNOWN)
            score = np.where(letters[run.first : run.last], score, 0.0)
            part = batch.slice(run.first, n)
            out.append(pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), pa.array(found, pa.string()), pa.array(score)], [*names, "lang_pred", "score"]))
        return out

    schema = T.StructType([*rows.drop("_letters").schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(rows, label, schema)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    return labelled(rows, model).drop("text")
