"""Toxicity by a convolutional text classifier with thresholds calibrated by language.

Words (lower-cased) and their first bytes, at several lengths, are hashed into embedding tables whose rows are
added: a word unseen in training still has the embedding of its stem, and a collision in one table
is outweighed by the others. Filters of several widths slide over the embedded words, a
rectifier and the maximum over the document follow, and a logistic unit scores the maxima. Training is numpy
with Adam; through the maximum, gradients reach only the windows that won.

A logit is calibrated by language: on labelled rows that the network was not trained on, each
language gets the threshold with the best F1, and the logit is shifted so that this threshold becomes
``CUT``. The language is predicted from the text by the language model; languages with fewer than
``LEAST_POSITIVES`` toxic rows share one threshold.

Learned from every labelled row outside the held-out fold, whole: those of three quarters of the ids train the network, shard by shard
(``shards.learn``), and all others calibrate it: their logits are counted by language in steps of 1 / ``STEPS``.
The whole text is scored, in slices that overlap by the widest filter. Null, empty and blank text
are one padding word and get a score too. Without labelled rows of both labels every score is 0.
"""

from __future__ import annotations


from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm import shards
from newslake.llm.common import fold, map_batches, text_or_empty
from newslake.llm.language import LanguageModel
from newslake.llm.sampling import one_per_id
from newslake.llm.textbytes import LOWER, Run, runs, span_hashes

FOLDS, HELD_OUT = 4, 2
ROUNDS, PASSES = 4, 2  # rounds over all shards, and times that a round goes through each text, however many there are
FEW = 32  # documents of an update
STEPS = 256  # of a logit, between which thresholds lie
CUT = 0.3
BUCKETS = 1 << 15  # rows of each embedding table; row 0 pads
SIZE = 8
STEMS = (4, 5, 6, 7)  # bytes
TABLES = 1 + len(STEMS)
WIDTHS = (1, 2, 3)
FILTERS = 12
LEAST_POSITIVES = 20
SLICE = 1 << 15  # windows convolved at once
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def word_codes(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word, padded so that no window reaches the next document; each document's first index."""
    data = LOWER[run.data]
    inside = _LETTER[data]
    begins, finish = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = run.starts[:-1][run.lengths > 0]
    begins[heads] = inside[heads]
    finish[:-1] &= ~inside[1:] | begins[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(finish) + 1
    hashed = span_hashes(data, start, end)
    owner = run.owners(start)
    n = len(run.lengths)
    count = np.bincount(owner, minlength=n)
    room = np.maximum(count, 1) + max(WIDTHS) - 1
    base = np.concatenate([[0], np.cumsum(room)])
    codes = np.zeros((int(base[-1]), TABLES), np.int32)
    at = base[owner] + np.arange(len(start)) - (np.cumsum(count) - count)[owner]
    for i, part in enumerate([hashed, *(span_hashes(data, start, np.minimum(end, start + k)) for k in STEMS)]):
        codes[at, i] = part % np.uint64(BUCKETS - 1) + np.uint64(1)
    return codes, base


class ConvModel:
    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        f = lambda scale, *shape: (r.normal(size=shape) * scale).astype(np.float32)
        self.tables = [f(0.03, BUCKETS, SIZE) for _ in range(TABLES)]
        for t in self.tables:
            t[0] = 0
        self.filters = [f(1 / np.sqrt(w * SIZE), w * SIZE, FILTERS) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = f(0.3, FILTERS * len(WIDTHS))
        self.bias = np.full(1, -1, np.float32)

    def small(self) -> dict[str, np.ndarray]:
        """All parameters but the embedding tables."""
        out = {"out": self.out, "bias": self.bias}
        for i in range(len(WIDTHS)):
            out |= {f"filter{i}": self.filters[i], f"shift{i}": self.shift[i]}
        return out

    def embed(self, codes: np.ndarray) -> np.ndarray:
        out = self.tables[0].take(codes[:, 0], axis=0)
        for i, table in enumerate(self.tables[1:], 1):
            out += table.take(codes[:, i], axis=0)
        return out

    def pooled(self, codes: np.ndarray, base: np.ndarray, won: np.ndarray | None = None) -> np.ndarray:
        """Maxima per document, and in ``won`` the first windows that have them. Long documents are convolved in slices."""
        out = np.zeros((len(base) - 1, FILTERS * len(WIDTHS)), np.float32)
        widest = max(WIDTHS)
        doc = np.repeat(np.arange(len(base) - 1), np.diff(base))
        real = np.ones(len(codes), bool)  # windows begin at words, not at the padding behind them
        for k in range(1, widest):
            real[base[1:] - k] = False
        for lo in range(0, len(codes), SLICE):
            hi = min(lo + SLICE, len(codes))
            e = self.embed(codes[lo : min(hi + widest - 1, len(codes))])
            e = np.vstack([e, np.zeros((widest - 1, SIZE), np.float32)])
            rows = np.flatnonzero(real[lo:hi])
            owner = doc[lo:hi][rows]
            if not len(rows):
                continue
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            for i, w in enumerate(WIDTHS):
                windows = np.hstack([e[rows + k] for k in range(w)])
                value = windows @ self.filters[i] + self.shift[i]
                most = np.maximum.reduceat(value, heads)
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                before = out[owner[heads], part]
                if won is not None:
                    at, column = np.nonzero((value == np.repeat(most, np.diff(np.append(heads, len(rows))), axis=0)))
                    at, column = at[::-1], column[::-1]  # the first window is written last
                    better = np.zeros(out.shape, bool)
                    better[owner[heads], part] = most > before
                    at, column = (x[better[owner[at], column + i * FILTERS]] for x in (at, column))
                    won[owner[at], column + i * FILTERS] = lo + rows[at]
                out[owner[heads], part] = np.maximum(before, most)
        return out

    def logits(self, codes: np.ndarray, base: np.ndarray) -> np.ndarray:
        return self.pooled(codes, base) @ self.out + self.bias

    def step(self, codes: np.ndarray, base: np.ndarray, y: np.ndarray, weight: np.ndarray, adam: Adam) -> None:
        """One update from a few documents."""
        n = len(base) - 1
        won = np.zeros((n, FILTERS * len(WIDTHS)), np.int64)
        pooled = self.pooled(codes, base, won)
        active = pooled > 0
        logit = pooled @ self.out + self.bias
        slope = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / n).astype(np.float32)
        back = slope[:, None] * self.out * active
        grads = {"out": pooled.T @ slope + 1e-4 * self.out, "bias": slope.sum(keepdims=True)}
        codes_hit, value_hit = [], []
        for i, w in enumerate(WIDTHS):
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            g = back[:, part]
            hit = [codes[won[:, part] + k] for k in range(w)]  # document, filter, table
            windows = np.concatenate([self.embed(c.reshape(-1, TABLES)).reshape(n, FILTERS, SIZE) for c in hit], axis=2)
            grads[f"filter{i}"] = np.einsum("dfx,df->xf", windows, g) + 1e-4 * self.filters[i]
            grads[f"shift{i}"] = g.sum(axis=0)
            used = active[:, part].ravel()
            for k in range(w):
                codes_hit.append(hit[k].reshape(-1, TABLES)[used])
                value_hit.append((g[:, :, None] * self.filters[i][k * SIZE : (k + 1) * SIZE].T).reshape(-1, SIZE)[used])
        adam.apply(self, grads, np.concatenate(codes_hit), np.concatenate(value_hit))


class Adam:
    """Adam for the small parameters; the touched embedding rows get Adagrad steps."""

    def __init__(self, model: ConvModel, rate: float = 0.01):
        self.rate, self.t = rate, np.zeros(1, np.float32)
        self.m, self.v = ({k: np.zeros_like(p) for k, p in model.small().items()} for _ in "mv")
        self.seen = [np.full(BUCKETS, 1e-6, np.float32) for _ in model.tables]

    def apply(self, model: ConvModel, grads: dict, codes: np.ndarray, values: np.ndarray) -> None:
        self.t += 1
        t = float(self.t[0])
        for k, p in model.small().items():
            m = self.m[k] = (0.9 * self.m[k] + 0.1 * grads[k]).astype(np.float32)
            v = self.v[k] = (0.999 * self.v[k] + 0.001 * grads[k] * grads[k]).astype(np.float32)
            p -= (self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        for j, table in enumerate(model.tables):
            rows, inverse = np.unique(codes[:, j], return_inverse=True)
            total = np.stack([np.bincount(inverse, values[:, c], len(rows)) for c in range(SIZE)], axis=1).astype(np.float32)
            self.seen[j][rows] += (total**2).mean(axis=1)
            table[rows] -= 0.1 * total / np.sqrt(self.seen[j][rows])[:, None]
            table[0] = 0


class Learner:
    """A network and its optimiser on one shard of the labelled texts; see ``shards.learn``."""

    def __init__(self, state: shards.State | None, seed: int, weights: tuple[float, float] = (1, 1)):
        self.model = ConvModel()
        self.adam, self.r = Adam(self.model), np.random.default_rng(seed)
        self.weights = np.array(weights, np.float32)
        for k, v in (state or {}).items():
            self.state()[k][...] = v

    def state(self) -> shards.State:
        out = self.model.small() | {"t": self.adam.t}
        for i, (table, seen) in enumerate(zip(self.model.tables, self.adam.seen, strict=True)):
            out |= {f"table{i}": table, f"seen{i}": seen}
        return out | {f"m.{k}": v for k, v in self.adam.m.items()} | {f"v.{k}": v for k, v in self.adam.v.items()}

    def add(self, texts: pa.Array, labels: np.ndarray) -> None:
        for run in runs(texts):
            codes, base = word_codes(run)
            y = labels[run.first : run.last]
            for _ in range(PASSES):
                order = self.r.permutation(len(y))
                for i in range(0, len(order), FEW):
                    docs = order[i : i + FEW]
                    own = np.concatenate([[0], np.cumsum(base[docs + 1] - base[docs])])
                    self.model.step(np.concatenate([codes[base[d] : base[d + 1]] for d in docs]), own, y[docs], self.weights[y[docs]], self.adam)


@dataclass
class ToxicityModel:
    network: ConvModel
    languages: LanguageModel | None
    thresholds: dict[str, float]  # logit by language; "" for all others

    def score(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated scores and predicted languages."""
        logit = self.network.logits(*word_codes(run)).astype(np.float64)
        names = self.languages.predict(run)[0] if self.languages else np.full(len(logit), "", object)
        at = np.array([self.thresholds.get(n, self.thresholds[""]) for n in names])
        shifted = logit - at + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -30, 30))), names


def best_threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the gap between neighbouring logits that gives the best F1."""
    order = np.argsort(-logit, kind="stable")
    logit, y, weight = logit[order], y[order], weight[order]
    hit, taken = np.cumsum(y * weight), np.cumsum(weight)
    f1 = 2 * hit / (taken + (y * weight).sum())
    ends = np.append(logit[1:] != logit[:-1], True)
    best = int(np.where(ends, f1, -1).argmax())
    below = logit[best + 1] if best + 1 < len(logit) else logit[best] - 2
    return float((logit[best] + below) / 2)


def _logits(network: ConvModel, languages: LanguageModel | None):
    def f(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        for run in runs(shards.texts_of(batch)):
            logit = np.clip(network.logits(*word_codes(run)), -30, 30)
            names = languages.predict(run)[0] if languages else [""] * len(logit)
            out.append(pa.RecordBatch.from_arrays(
                [batch.column("label").slice(run.first, len(logit)), pa.array(names, pa.string()),
                 pa.array(np.floor(logit * STEPS).astype(np.int32))], ["label", "name", "logit"]))
        return out

    return f


def fit(docs: DataFrame, labels: DataFrame, languages: LanguageModel | None) -> ToxicityModel | None:
    """Learn from all labelled rows outside the held-out fold; None unless both labels occur."""
    known = one_per_id(labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)), "toxic")
    tuned = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 3
    rows = shards.labelled_shards(docs, known, "toxic")
    counts = {(r.tuned, r.label): r["count"] for r in rows.groupBy(tuned.alias("tuned"), "label").count().collect()}
    if len({label for _, label in counts}) < 2:
        return None
    taught, tuning = rows.where(~tuned), rows.where(tuned)
    if len(counts) < 4:
        taught = tuning = rows
        counts = {(False, y): counts.get((True, y), 0) + counts.get((False, y), 0) for y in (0, 1)}
    clean, toxic = counts[False, 0], counts[False, 1]
    n = clean + toxic
    weights = n / (2 * clean), n / (2 * toxic)
    state = shards.learn(taught, Learner(None, 0).state(), lambda state, seed: Learner(state, seed, weights), ROUNDS)
    network = Learner(state, 0).model
    found = map_batches(tuning, _logits(network, languages), "label int, name string, logit int").groupBy("name", "logit", "label").count().toArrow()
    logit, y, count = (found.column(c).to_numpy().astype(np.float64) for c in ("logit", "label", "count"))
    logit, names = (logit + 0.5) / STEPS, np.array(found.column("name").to_pylist(), object)
    thresholds = {"": best_threshold(logit, y, count)}
    for name in sorted(set(names)):
        mine = names == name
        if count[mine] @ y[mine] >= LEAST_POSITIVES and count[mine] @ (1 - y[mine]) >= LEAST_POSITIVES:
            thresholds[name] = best_threshold(logit[mine], y[mine], count[mine])
    return ToxicityModel(network, languages, thresholds)


RESULT = "doc_id long, held_out boolean, score double, predicted int, lang_pred string"


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and the language whose threshold was used."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       text_or_empty().alias("text"))

    def apply(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        for run in runs(batch.column("text")):
            n = run.last - run.first
            value, names = (np.zeros(n), np.full(n, "", object)) if model is None else model.score(run)
            part = batch.slice(run.first, n)
            out.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(value), pa.array((value >= CUT).astype(np.int32)), pa.array(names, pa.string())],
                ["doc_id", "held_out", "score", "predicted", "lang_pred"]))
        return out

    return map_batches(rows, apply, RESULT)
