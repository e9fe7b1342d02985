"""Packing documents into windows of tokens by non-negative least squares.

A document is its token ids and an end id. Whole windows are cut off its front; what remains is rounded up to units of
``WINDOW / UNITS`` tokens. All combinations of up to ``DEPTH`` rounded lengths that fill a window exactly are enumerated, and
the number of times each is used is solved by non-negative least squares (active sets) against the histogram of lengths, rounded, and
kept within what the histogram holds. A remainder's place among those of its length (from range partitioning, so a length
that a third of all documents have is no single task's) then tells its sequence, without any search.

The residual is packed greedily: remainders that no combination took are laid end to end as a tape. The tape first
fills what rounding left open in the combined sequences, then whole windows, and its last tokens sequences of descending powers of two,
which need no padding. Only remainders on the tape are cut. If the tape is shorter than the open space, as many combined
sequences as needed are given up to the tape, which can be computed beforehand. So no sequence is padded at all.

The driver sees the histogram (``UNITS`` numbers) and a plan of at most ``UNITS ** 2`` rows. Texts are encoded once; of the ids only those of
remainders are stored, two bytes each for small vocabularies. Checksums of whole pieces are taken where the text is encoded; pieces cut
from the tape meet the stored ids again.

Distinct pieces of words between ASCII white space are encoded once per worker; the vocabulary drops white space, which no token and no added token
contains, so the words' ids in a row are the text's. Null text is empty: its document is the end id alone. Repeated rows and null ids are documents of their
own. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslake.llm.common import map_batches
from newslake.llm.textbytes import LOWER, SPACE, Run, runs
from newslake.operators.position import numbered, running_total
from newslake.session import settle

WINDOW = 4096
UNITS = 32
DEPTH = 8
END_ID = 2
BLOCK = 1 << 18  # tokens of the tape that one task cuts at a time
MOST_WORDS = 400_000  # pieces and odd words that a worker keeps; beyond, it starts anew
MOST_MERGED = 32  # bytes of a piece that is merged in arrays; longer ones go to the library
RUN_BYTES = 4 << 20
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)
# How the vocabulary cuts lower-case text, the same over the letters of PLAIN, and its mark of a word's end.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]|[^\\sa-z0-9À-ÖØ-öø-ſ]+")
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")  # lower case and composition change nothing else about these
WORD_END = "</w>"


def _kinds() -> np.ndarray:
    kind = np.full(256, ODD, np.uint8)
    kind[33:127] = SIGN
    kind[48:58] = DIGIT
    kind[65:91] = kind[97:123] = LETTER
    kind[SPACE] = BLANK
    return kind


KIND = _kinds()
NEVER = np.iinfo(np.int32).max


class Merges:
    """Byte-pair merging of many short pieces at once: in each round every piece merges its leftmost pair of lowest rank."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[letters[b] + WORD_END] for b in range(256)], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER)

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all ids in a row. No piece may be empty."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data, begin = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths
        sizes, done = np.zeros(len(pieces), np.int64), []
        who, ids, ranks = np.zeros(0, np.int64), np.zeros((0, 0), np.int32), np.zeros((0, 0), np.int32)
        for n in range(int(lengths.max(initial=0)), 0, -1):
            fresh = np.flatnonzero(lengths == n)
            symbols = data[begin[fresh][:, None] + np.arange(n)]
            symbols = np.concatenate([self.inner[symbols[:, :-1]], self.last[symbols[:, -1:]]], axis=1)
            pairs = self.ranks(symbols[:, :-1], symbols[:, 1:])
            if len(who):
                symbols, pairs, fresh = np.concatenate([symbols, ids]), np.concatenate([pairs, ranks]), np.concatenate([fresh, who])
            if not len(fresh):
                continue
            best = pairs.argmin(axis=1) if n > 1 else np.zeros(len(fresh), np.int64)
            lowest = pairs[np.arange(len(fresh)), best] if n > 1 else np.full(len(fresh), NEVER)
            ended = lowest == NEVER
            sizes[fresh[ended]] = n
            done.append((fresh[ended], symbols[ended]))
            who, best, symbols, pairs = fresh[~ended], best[~ended], symbols[~ended], pairs[~ended]
            rows = np.arange(len(who))
            symbols[rows, best] = self.made[lowest[~ended]]
            ids = symbols[np.arange(n) != best[:, None] + 1].reshape(len(who), n - 1)
            ranks = pairs[np.arange(n - 1) != best[:, None]].reshape(len(who), max(n - 2, 0))
            before, after = np.flatnonzero(best > 0), np.flatnonzero(best < n - 2)
            ranks[before, best[before] - 1] = self.ranks(ids[before, best[before] - 1], ids[before, best[before]])
            ranks[after, best[after]] = self.ranks(ids[after, best[after]], ids[after, best[after] + 1])
        first, out = np.cumsum(sizes) - sizes, np.zeros(int(sizes.sum()), np.uint32)
        for some, found in done:
            out[first[some][:, None] + np.arange(found.shape[1])] = found
        return sizes, out


class WordEncoder:
    """Ids of texts, each distinct piece encoded once.

    Words of printable ASCII are cut, all at once, as the vocabulary cuts them. Words of ASCII and Latin letters are cut by PIECES. New short
    pieces are merged in arrays. All other words, words that hold an added token, and long pieces go to the library as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        parts = json.loads(self.library.to_str())
        if parts["model"].get("end_of_word_suffix") != WORD_END or SPLIT not in json.dumps(parts["pre_tokenizer"]).replace("\\\\", "\\"):
            raise ValueError("a vocabulary that cuts words otherwise")
        self.merges = Merges(parts["model"])
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.added = re.compile(b"|".join(re.escape(t.content.encode()) for t in self.library.get_added_tokens_decoder().values()) or b"(?!)")
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _units(self, run: Run) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Pieces of plain words and whole odd words in a row; which are odd; where each text begins among them."""
        kind = KIND[run.data]
        for found in self.added.finditer(run.data.tobytes()):
            kind[found.start()] = ODD
        solid = kind != BLANK
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        heads = run.starts[:-1][run.lengths > 0]
        begins[heads] = solid[heads]
        upto = np.concatenate([[0], np.cumsum(solid)])[run.starts]
        body, kind, begins = run.data[solid], kind[solid], begins[solid]
        words = np.flatnonzero(begins)
        odd = np.maximum.reduceat(kind, words) == ODD if len(words) else np.zeros(0, bool)
        odd = np.repeat(odd, np.diff(words, append=len(body)))
        body = np.where(odd, body, LOWER[body])
        cut = kind == DIGIT
        cut[1:] |= kind[1:] != kind[:-1]
        cut = (cut & ~odd) | begins
        inner = np.concatenate([np.where(begins, 0, body), np.zeros(2, np.uint8)])
        at = np.flatnonzero(cut & ~odd & (body == ord("'")))
        one, two = inner[at + 1], inner[at + 1].astype(np.int64) << 8 | inner[at + 2]
        short, long = np.isin(one, list(b"stmd")), np.isin(two, [int.from_bytes(b, "big") for b in (b"re", b"ve", b"ll")])
        at, after = at[short | long], (at + 2 + long)[short | long]
        cut[at + 1] = False
        cut[after[after < len(cut)]] = True
        first = np.flatnonzero(cut)
        offsets = np.append(first, len(body)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        return units, odd[first], np.searchsorted(first, upto)

    def _store(self, units: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units)), strict=True))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.first[at + 1] - self.first[at]
        ends = np.cumsum(sizes)
        return sizes, self.ids[np.arange(int(sizes.sum())) + np.repeat(self.first[at] - ends + sizes, sizes)]

    def _learn(self, pieces: list[bytes], odd: list[bytes]) -> None:
        """Store new pieces and new odd words."""
        names = [w.decode() for w in odd]
        cuts = [PIECES.findall(n.lower()) if PLAIN.fullmatch(n) and not self.added.search(w) else [] for n, w in zip(names, odd, strict=True)]
        cuts = [[c.encode() for c in cs] for cs in cuts]
        pieces = list(dict.fromkeys([*pieces, *(c for cs in cuts for c in cs if c not in self.index)]))
        short = [p for p in pieces if len(p) <= MOST_MERGED]
        if short:
            self._store(short, *self.merges(short))
        whole = [p for p in pieces if len(p) > MOST_MERGED] + [w for w, cs in zip(odd, cuts, strict=True) if not cs]
        if whole:
            found = [e.ids for e in self.library.encode_batch([w.decode() for w in whole], add_special_tokens=False)]
            self._store(whole, np.array([len(f) for f in found]), np.array([i for f in found for i in f], np.uint32))
        joined = [(w, cs) for w, cs in zip(odd, cuts, strict=True) if cs and w not in self.index]
        if joined:
            sizes, ids = self._gather(np.array([self.index[c] for _, cs in joined for c in cs]))
            heads = np.cumsum([0, *(len(cs) for _, cs in joined)])[:-1]
            self._store([w for w, _ in joined], np.add.reduceat(sizes, heads), ids)

    def encode(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the run's texts in a row, and where each text begins in it."""
        if len(self.index) > MOST_WORDS:
            self.forget()
        units, odd, begin = self._units(run)
        coded = units.dictionary_encode()
        code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        is_odd = np.zeros(len(distinct), bool)
        is_odd[code] = odd
        new = [(u, o) for u, o in zip(distinct, is_odd.tolist(), strict=True) if u not in self.index]
        self._learn([u for u, o in new if not o], [u for u, o in new if o])
        at = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        sizes, ids = self._gather(at[code])
        return ids, np.concatenate([[0], np.cumsum(sizes)])[begin]


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encoded(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Per row: row (a number of its own), doc_id, doc_tokens, crcs of its whole windows, rest (tokens after them), rest_crc, rest_ids."""

    def each(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        known = encoder(path)
        tokens, crcs, rests, rest_crcs, rest_ids = [], [], [], [], []
        for run in runs(batch.column("text"), RUN_BYTES):
            found, begin = known.encode(run)
            for ids in np.split(found, begin[1:-1]):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                raw, whole = ids.tobytes(), len(ids) // window
                tokens.append(len(ids))
                crcs.append([crc32(raw[4 * window * k : 4 * window * (k + 1)]) for k in range(whole)])
                rests.append(len(ids) - whole * window)
                rest_crcs.append(crc32(raw[4 * window * whole :]))
                rest_ids.append(ids[whole * window :].astype(known.kind).tobytes())
        columns = [batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.int64()),
                   pa.array(rest_crcs, pa.int64()), pa.array(rest_ids, pa.binary())]
        return [pa.RecordBatch.from_arrays(columns, names)]

    names = ["doc_id", "doc_tokens", "crcs", "rest", "rest_crc", "rest_ids"]
    schema = "doc_id long, doc_tokens long, crcs array<long>, rest long, rest_crc long, rest_ids binary"
    rows = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), each, schema)
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")


def combinations(units: int = UNITS, depth: int = DEPTH) -> np.ndarray:
    """Uses of each length (row 0: one unit) by every way to write ``units`` as a sum of up to ``depth`` lengths."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int, most: int) -> None:
        if left == 0:
            found.append(parts)
        elif len(parts) < depth:
            for part in range(min(left, most), 0, -1):
                if part * (depth - len(parts)) < left:
                    break
                extend([*parts, part], left - part, part)

    extend([], units, units)
    return np.stack([np.bincount(p, minlength=units + 1)[1:] for p in found], axis=1).astype(np.float64)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that makes ``a @ x`` closest to ``b``: grow the set of free columns by the steepest, drop those that turn negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    enough = 1e-9 * max(float(np.abs(a.T @ b).max(initial=0.0)), 1.0)
    for _ in range(20 * a.shape[0]):
        slope = np.where(free, -np.inf, a.T @ (b - a @ x))
        if slope.max() <= enough:
            break
        free[int(slope.argmax())] = True
        while True:
            trial = np.zeros_like(x)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (trial[free] > 0).all():
                break
            bad = free & (trial <= 0)
            share = (x[bad] / np.maximum(x[bad] - trial[bad], 1e-300)).min()
            x = x + share * (trial - x)
            free &= x > 1e-12
            x[~free] = 0
        x = trial
    return x


def repeats(histogram: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Combinations that are used (columns) and how often, never more than the histogram holds."""
    ways = combinations(len(histogram), depth)
    solved = nonnegative_least_squares(ways, histogram.astype(np.float64))
    left, times = histogram.astype(np.int64).copy(), np.zeros(ways.shape[1], np.int64)
    for k in np.argsort(-solved, kind="stable"):
        if solved[k] < 0.5:
            break
        needs = ways[:, k].astype(np.int64)
        times[k] = min(round(solved[k]), int((left[needs > 0] // needs[needs > 0]).min()))
        left -= times[k] * needs
    used = np.flatnonzero(times)
    return ways[:, used].astype(np.int64), times[used]


PLAN = "length long, after long, upto long, sequence long, copies long"


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, after, upto, sequence, copies): of that length, the places after..upto go to the sequences from ``sequence`` on, ``copies`` to each."""
    ways, times = repeats(histogram, depth)
    rows, taken, sequence = [], np.zeros(len(histogram), np.int64), 0
    for needs, n in zip(ways.T, times, strict=True):
        for unit in np.flatnonzero(needs):
            upto = taken[unit] + n * needs[unit]
            rows.append((int(unit) + 1, int(taken[unit]), int(upto), sequence, int(needs[unit])))
            taken[unit] = upto
        sequence += int(n)
    return rows


def _combined(rests: DataFrame, histogram: np.ndarray, window: int) -> tuple[DataFrame, int]:
    """Remainders with ``sequence``, null on the tape, and the number of combined sequences."""
    rows = plan(histogram)
    placed = numbered(rests, ["length"], ["row"], "place")
    if not rows:
        return placed.drop("place").withColumn("sequence", F.lit(None).cast("long")), 0
    steps = rests.sparkSession.createDataFrame(rows, PLAN).withColumnRenamed("length", "of_length")
    here = (F.col("length") == F.col("of_length")) & (F.col("place") > F.col("after")) & (F.col("place") <= F.col("upto"))
    rank = F.col("place") - F.col("after") - 1
    chosen = placed.join(steps, here, "left").withColumn("sequence", F.col("sequence") + F.expr("(place - after - 1) div copies"))
    chosen = settle(chosen.select(*rests.columns, "sequence"), "combined")
    sequences = max(s + (u - a) // c for _, a, u, s, c in rows)
    sums = chosen.agg(F.sum(F.when(F.col("sequence").isNull(), F.col("rest"))).alias("tape"), F.sum(F.when(F.col("sequence").isNotNull(), F.col("rest"))).alias("held")).first()
    missing = sequences * window - (sums["held"] or 0) - (sums["tape"] or 0)
    sequences -= max(0, -(-missing // window))  # giving up one moves a window from open space to the tape
    return chosen.withColumn("sequence", F.when(F.col("sequence") < sequences, F.col("sequence"))), sequences


def _powers(tokens: int) -> list[int]:
    return [1 << k for k in reversed(range(tokens.bit_length())) if tokens >> k & 1]


def _tape_slots(spark: SparkSession, open_space: DataFrame, first: int, filled: int, length: int, window: int) -> tuple[DataFrame, int]:
    """Slots (begin, upto on the tape, sequence, slot_offset) that cover the tape, and the next free sequence."""
    whole, rest = divmod(length - filled, window)
    slots = open_space
    columns = [F.lit(filled) + F.col("id") * window, F.lit(filled) + (F.col("id") + 1) * window, F.col("id") + first, F.lit(0).cast("long")]
    more = spark.range(whole).select(*(c.cast("long").alias(n) for c, n in zip(columns, slots.columns, strict=True)))
    begin, rows = filled + whole * window, []
    for k, size in enumerate(_powers(rest)):
        rows.append((begin, begin + size, first + whole + k, 0))
        begin += size
    slots = slots.unionByName(more)
    if rows:
        slots = slots.unionByName(spark.createDataFrame(rows, slots.schema))
    return slots, first + whole + len(rows)


def _cut(pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """Segments of the pieces by slots; both cover the tape without gaps. Block by block, a merge of both kinds of edges."""

    def blocks(df: DataFrame, mine: str, other: str) -> DataFrame:
        kinds = {mine: F.struct(*df.columns), other: F.lit(None)}
        number = F.expr(f"explode(sequence(begin div {BLOCK}, (upto - 1) div {BLOCK}))")
        listed = df.select(*(kinds[k].alias(k) for k in sorted(kinds)), "begin", number.alias("block"))
        return listed.select("block", F.greatest("begin", F.col("block") * BLOCK).alias("at"), "piece", "slot")

    edges = blocks(pieces, "piece", "slot").withColumn("slot", F.lit(None).cast(slots.schema))
    edges = edges.unionByName(blocks(slots, "slot", "piece").withColumn("piece", F.lit(None).cast(pieces.schema)))
    order = Window.partitionBy("block").orderBy("at")
    sofar = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = edges.select("at", F.last("piece", True).over(sofar).alias("p"), F.last("slot", True).over(sofar).alias("s"),
                        F.lead("at").over(order).alias("following"), "block")
    following = F.coalesce("following", F.least((F.col("block") + 1) * BLOCK, F.col("p.upto")))
    length = (following - F.col("at")).alias("length")
    into = F.col("at") - F.col("p.begin")
    return both.select("p.row", into.alias("skip"), length, F.col("s.sequence").alias("sequence"),
                       (F.col("s.slot_offset") + F.col("at") - F.col("s.begin")).alias("offset")).where("length > 0")


OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
OUT_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _checked(path: str):
    """Pieces of remainders that the tape cuts, with their checksums; segments that only a block's edge parted are joined again."""

    def each(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        kind, out = encoder(path).kind, []
        for r in batch.to_pylist():
            raw = np.frombuffer(r["rest_ids"], kind).astype("<u4").tobytes()
            pieces: list[list[int]] = []
            for s in sorted(r["segments"], key=lambda s: s["skip"]):
                if pieces and (pieces[-1][2], pieces[-1][3] + pieces[-1][1]) == (s["sequence"], s["offset"]):
                    pieces[-1][1] += s["length"]
                else:
                    pieces.append([s["skip"], s["length"], s["sequence"], s["offset"]])
            before = r["doc_tokens"] - len(raw) // 4
            out += [(r["doc_id"], before + skip, size, crc32(raw[4 * skip : 4 * (skip + size)]), r["doc_tokens"], sequence, offset) for skip, size, sequence, offset in pieces]
        columns = zip(*out, strict=True) if out else [[]] * len(OUT)
        return [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], OUT)]

    return each


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    texts = encoded(docs, path, window)
    unit = window // UNITS
    rests = texts.where("rest > 0").select("row", "doc_id", "doc_tokens", "rest", "rest_crc", F.expr(f"(rest + {unit - 1}) div {unit}").alias("length"))
    histogram = np.zeros(UNITS, np.int64)
    for r in rests.groupBy("length").count().collect():
        histogram[r["length"] - 1] = r["count"]
    chosen, sequences = _combined(rests, histogram, window)
    inside = Window.partitionBy("sequence").orderBy(F.desc("rest"), "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = settle(chosen.where("sequence is not null").withColumn("after", F.sum("rest").over(inside)), "held")
    open_space = held.groupBy("sequence").agg(F.max("after").alias("slot_offset")).withColumn("space", F.lit(window) - F.col("slot_offset")).where("space > 0")
    filled = open_space.agg(F.sum("space")).first()[0] or 0
    open_space = running_total(open_space, [], ["sequence"], F.col("space"), "upto")
    open_space = open_space.select((F.col("upto") - F.col("space")).alias("begin"), "upto", "sequence", F.col("slot_offset").cast("long").alias("slot_offset"))
    tape = running_total(chosen.where("sequence is null"), [], ["row"], F.col("rest"), "upto").withColumn("begin", F.col("upto") - F.col("rest"))
    tape = settle(tape.select("row", "doc_id", "doc_tokens", "rest", "rest_crc", "begin", "upto"), "tape")
    length = tape.agg(F.max("upto")).first()[0] or 0
    slots, following = _tape_slots(spark, open_space, sequences, filled, length, window)
    segments = _cut(tape.select("row", "begin", "upto"), slots)
    parts = settle(segments.groupBy("row").agg(F.collect_list(F.struct("skip", "length", "sequence", "offset")).alias("segments")), "segments")
    start = (F.col("doc_tokens") - F.col("rest")).alias("start")
    kept = held.select("doc_id", start, F.col("rest").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens", F.col("sequence").alias("sequence_id"),
                       (F.col("after") - F.col("rest")).alias("offset"))
    whole = tape.join(parts.where("size(segments) = 1"), "row").select("doc_id", start, F.col("rest").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens",
                       F.col("segments")[0]["sequence"].alias("sequence_id"), F.col("segments")[0]["offset"].alias("offset"))
    # Merged at every size: what is cut grows with the input, and a broadcast here would only hide the shuffle in small runs.
    cut = texts.join(parts.where("size(segments) > 1").hint("merge"), "row").select("doc_id", "doc_tokens", "rest_ids", "segments")
    cut = map_batches(cut, _checked(path), OUT_SCHEMA)
    long = running_total(texts.where("size(crcs) > 0").select("row", "doc_id", "doc_tokens", "crcs"), [], ["row"], F.size("crcs"), "upto")
    before = F.col("upto") - F.size("crcs") + following
    front = long.select("doc_id", "doc_tokens", before.alias("before"), F.posexplode("crcs").alias("k", "ids_crc32"))
    front = front.select("doc_id", (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                         (F.col("before") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return kept.select(OUT).unionByName(whole.select(OUT)).unionByName(cut).unionByName(front.select(OUT))
