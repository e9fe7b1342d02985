"""Mixing documents to target weights by iterative proportional fitting.

Tokens are summed per cell of source, language and topic. The cells' weights are raked: scaled to
the target of each source, then of each language, then of each topic, and again, until all three
marginals hold or come no closer; what is left is returned per marginal. A cell's weight over its tokens is the rate at which its tokens should be taken; rates
are scaled to a token budget, those above one are cut to one and the rest raised accordingly. A
document is taken with its cell's probability, decided by a hash of its id, so the expected
token mix of the sample follows the targets and a rerun takes the same documents.

Only the table of cells is iterated, as a table in the shared folder; each round returns one number
to the driver. Texts are read once for topic and tokens; ``sampled`` reads them once more.

Null sources and languages are labels of their own (empty text). The topic is read off the text: ``TOPICS``.
A target absent from the data is left out and the others are scaled to one; a label without a target keeps its
share of tokens. Documents without tokens carry no weight and are not taken. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import map_batches
from newslake.llm.textbytes import SPACE, Run, runs
from newslake.session import estimated_bytes, settle

DIMENSIONS = ("source", "lang", "topic")
MISSES = [f"miss_{d}" for d in DIMENSIONS]
# Without explicit targets a label's share is its token share to this power, scaled to one.
TEMPERATURE = {"source": 0.5, "lang": 0.7, "topic": 0.8}
BUDGET = 0.5  # of all tokens
SEED = 20240607
CLOSE = 1e-6  # largest relative miss of a marginal at which raking ends
STALE, FALL = 5, 0.99  # it also ends when so many rounds have not brought the largest miss below this share of what it was
# A text's topic is the first whose characters make more than its limit of the text.
TOPICS = ("symbols", "figures", "listing", "prose")
LIMITS = (0.05, 0.1, 0.02)
KIND = np.full(256, len(LIMITS), np.uint8)
for _k, _chars in enumerate((b"#*$%&|<>{}[]=_", b"0123456789", b"\n")):
    KIND[list(_chars)] = _k
CELL_BYTES = 1 << 24  # of Parquet files


def described(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, ``topic`` and ``tokens`` (words) of each row.

    The topic says what a text consists of: many symbols, many digits, many short lines, or none of these.
    """
    columns = [c for c in columns if c not in ("topic", "tokens")]

    def each(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        topics, tokens = [], []
        for run in runs(batch.column("text")):
            inside = ~SPACE[run.data]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            heads = run.starts[:-1][run.lengths > 0]
            begins[heads] = inside[heads]
            tokens.append(_per_text(begins, run))
            chars = np.maximum(_per_text((run.data & 0xC0) != 0x80, run), 1)
            kind = KIND[run.data]
            shares = [_per_text(kind == k, run) / chars > limit for k, limit in enumerate(LIMITS)]
            topics.append(np.select(shares, TOPICS[:-1], TOPICS[-1]))
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        out = [*(batch.column(c) for c in columns), join(topics, pa.string()), join(tokens, pa.int64())]
        return [pa.RecordBatch.from_arrays(out, [*columns, "topic", "tokens"])]

    schema = docs.select(columns).schema.add("topic", "string").add("tokens", "long")
    return map_batches(docs.select(*dict.fromkeys([*columns, "text"])), each, schema)


def _per_text(mask: np.ndarray, run: Run) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(mask), run.starts))


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic and tokens (words) of each row."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in DIMENSIONS[:2]), "text")
    return described(df, ["doc_id", *DIMENSIONS[:2]])


def _together(cells: DataFrame) -> DataFrame:
    """Cells in one partition where their files fit into one: grouping and joining them then needs no exchange."""
    return cells.coalesce(1) if estimated_bytes(cells) <= CELL_BYTES else cells


def _targets(cells: DataFrame, dimension: str, given: dict[str, float] | None) -> DataFrame:
    """(label, target): shares that sum to one over the labels present."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    wanted = F.pow("tokens", F.lit(TEMPERATURE[dimension]))
    if given:
        total = cells.agg(F.sum("tokens")).first()[0] or 1
        table = F.create_map(*(F.lit(x) for pair in given.items() for x in pair))
        wanted = F.coalesce(table[F.col(dimension)], F.col("tokens") / F.lit(float(total)))
    scored = sums.withColumn("wanted", wanted)
    total = scored.agg(F.sum("wanted")).first()[0] or 1.0
    return settle(scored.select(dimension, (F.col("wanted") / F.lit(float(total))).alias("target")), f"target-{dimension}")


def _misses(state: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with ``miss_`` of each dimension: by how much of its target the sum over the cell's label misses it."""
    for d in DIMENSIONS:
        sums = state.groupBy(d).agg(F.sum("weight").alias("now")).join(targets[d], d)
        off = F.abs(F.col("now") / F.col("target") - 1)
        state = _together(settle(state.join(sums.select(d, F.coalesce(off, F.lit(0.0)).alias(f"miss_{d}")), d), "missed-cells"))
    return state


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with ``weight`` and ``miss_source``, ``miss_lang``, ``miss_topic``.

    Rounds go on until all sums equal their targets to ``CLOSE`` or no longer come closer. Where cells cannot meet all targets
    (a source found in one language only, say), the last dimension holds and the misses tell how far off the others are.
    """
    state = _together(cells).withColumn("weight", F.col("tokens").cast("double"))
    targets = {d: _together(t) for d, t in targets.items()}
    seen: list[float] = []
    while True:
        errors = []
        for d in DIMENSIONS:
            sums = state.groupBy(d).agg(F.sum("weight").alias("now")).join(targets[d], d)
            factors = sums.select(d, (F.col("target") / F.col("now")).alias("factor"))
            state = state.join(factors, d).withColumn(f"off_{d}", F.abs(F.col("factor") - 1)).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
            errors.append(f"off_{d}")
        state = _together(settle(state, "raked-cells"))
        seen.append(state.agg(F.max(F.greatest(*errors))).first()[0] or 0.0)
        state = state.drop(*errors)
        if seen[-1] < CLOSE or (len(seen) > STALE and seen[-1] > FALL * seen[-1 - STALE]):
            return _misses(state, targets)


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """Cells with ``probability``: proportional to weight per token, at most one, expecting ``budget`` of all tokens."""
    rated = settle(cells.withColumn("rate", F.col("weight") / F.col("tokens")), "rated-cells")
    total = rated.agg(F.sum("tokens")).first()[0] or 0
    scale = 0.0
    full = rated.where("false")
    while total:
        whole = F.col("rate") * F.lit(scale) >= 1
        row = rated.agg(F.sum(F.when(whole, F.col("tokens"))).alias("full"), F.sum(F.when(~whole, F.col("weight"))).alias("open")).first()
        left = budget * total - (row["full"] or 0)
        new = left / row["open"] if row["open"] and left > 0 else scale
        if not math.isfinite(new) or new <= scale * (1 + 1e-12):
            break
        scale = new
    return rated.withColumn("probability", F.least(F.col("rate") * F.lit(scale), F.lit(1.0))).drop("rate")


def draw() -> Column:
    """A number in [0, 1) that depends on the document's id only."""
    return F.xxhash64(F.lit(SEED), F.coalesce(F.col("doc_id"), F.lit(-1).cast("long"))).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))


def chances(rows: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """(source, lang, topic, probability) of each cell of labelled rows."""
    cells = _together(settle(rows.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells"))
    wanted = {d: _targets(cells, d, (targets or {}).get(d)) for d in DIMENSIONS}
    return settle(probabilities(rake(cells, wanted), budget).drop("tokens", "weight"), "chances")


def _with_chance(rows: DataFrame, found: DataFrame, *more: str) -> DataFrame:
    """Rows with ``probability``, further columns of the cell and ``taken``; labels as columns _source, _lang and topic."""
    same = reduce(lambda a, b: a & b, (F.col(f"r.{r}") == F.col(f"c.{c}") for r, c in zip(("_source", "_lang", "topic"), DIMENSIONS, strict=True)))
    p = F.when(F.col("tokens") > 0, F.coalesce("c.probability", F.lit(0.0))).otherwise(0.0)
    joined = rows.alias("r").join(found.alias("c"), same, "left").select("r.*", p.alias("probability"), *(F.col(f"c.{m}") for m in more))
    return joined.withColumn("taken", draw() < F.col("probability"))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """Per row: doc_id, source, lang, topic, tokens, probability, whether it is taken, and the misses of its cell's marginals (null without a cell)."""
    rows = settle(labelled(docs), "labelled")
    found = chances(rows, targets, budget)
    rows = rows.withColumnsRenamed({"source": "_source", "lang": "_lang"})
    labels = [F.col("_source").alias("source"), F.col("_lang").alias("lang"), "topic"]
    return _with_chance(rows, found, *MISSES).select("doc_id", *labels, "tokens", "probability", "taken", *MISSES)


def sampled(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """The documents taken, with topic, tokens and probability added."""
    found = chances(labelled(docs), targets, budget)
    rows = described(docs, docs.columns).withColumns({"_source": F.coalesce("source", F.lit("")), "_lang": F.coalesce("lang", F.lit(""))})
    return _with_chance(rows, found).where("taken").drop("_source", "_lang", "taken")
