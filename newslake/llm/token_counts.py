"""Exact token counts at every prefix, by dynamic programming over byte-level BPE.

A text is cut into pre-tokens; a pre-token's encoding does not depend on the others. Within a pre-token
the encoding of each prefix ends in one token, and that token is the only one that is a
suffix of the prefix and *fits* the last token of what is before it: merging the two's bytes
gives the same two tokens. So one pass over the bytes yields the last token, and hence
the count, at each prefix. Rows of counts are kept per pre-token; the count of a text, the longest prefix within a
budget and the count at any byte follow by adding up, without encoding again.

Prefix counts refer to the text's own pre-tokens: a prefix that ends inside one counts that part
as it would be encoded on its own. Strings of added tokens inside a text are one token each, as in
the library's default. Null text is empty.

The vocabulary file is a parameter. Each Python worker keeps at most ``MOST_KEPT``
pre-tokens in memory and forgets the older half when they are full, which changes no result.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import map_batches, text_or_empty

LIMIT = 1024
MOST_KEPT = 400_000
AT_ONCE = 1 << 20  # bytes of texts cut into pre-tokens together
# How byte-level BPE files split text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The printable characters by which such files write the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in set(shown)):
        letters[chr(256 + n)] = b
    return letters


class PrefixCounter:
    """Prefix counts of texts under one vocabulary file (tokenizers .json, byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.merges: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[raw(left), raw(right)] = rank
        # Tokens by number: bytes first, then merged ones by rank; of a token that several pairs give, the first.
        self.tokens = {bytes([b]): b for b in range(256)}
        self.halves = [(b, b) for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        for (left, right), rank in self.merges.items():
            n = self.tokens.setdefault(left + right, 256 + rank)
            self.halves += [(-1, -1)] * (256 + rank + 1 - len(self.halves))
            if n == 256 + rank:
                self.halves[n] = self.tokens[left], self.tokens[right]
            self.pairs[self.tokens[left], self.tokens[right]] = n
        self.plain = len(self.tokens) == 256 + len(self.merges)  # each token comes from one pair
        self.reach: dict[bytes, int] = {}  # bytes of the longest token that ends in these three
        for token in self.tokens:
            if len(token) > 2 and len(token) > self.reach.get(token[-3:], 0):
                self.reach[token[-3:]] = len(token)
        self.whole: dict[bytes, bool] = {}
        self.added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known = _Known(self)

    def merge(self, piece: bytes) -> list[bytes]:
        """Plain BPE: merge the pair of the lowest rank until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [(self.merges.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _is_whole(self, token: bytes) -> bool:
        """Whether a token's bytes are encoded as that token."""
        if token not in self.whole:
            self.whole[token] = self.merge(token) == [token]
        return self.whole[token]

    def _fit(self, before: bytes, token: bytes) -> bool:
        """Whether the two tokens' bytes are encoded as these two.

        They are unless some merge across the border, of the tokens or of the halves they were made of, comes before the merges
        that made what lies beside the border. So the token made last is taken apart again and again, and the pair at the border looked up.
        """
        pair = before, token
        found = self.fits.get(pair)
        if found is None:
            if len(self.fits) > MOST_KEPT:
                self.fits.clear()
            if self.plain and self._is_whole(before) and self._is_whole(token):
                found = self._stays(self.tokens[before], self.tokens[token])
            else:
                found = self.merge(before + token) == [before, token]
            self.fits[pair] = found
        return found

    def _stays(self, left: int, right: int) -> bool:
        pairs, halves = self.pairs, self.halves
        limit = 1 << 60
        while True:
            if pairs.get((left, right), limit) < limit:
                return False
            if left < 256 and right < 256:
                return True
            # Of equal numbers the left one is made first.
            if left > right:
                limit, left = left, halves[left][1]
            else:
                limit, right = right + 1, halves[right][0]

    def row(self, piece: bytes) -> list[int]:
        """Token count of each prefix of one pre-token; entry 0 is 0."""
        last, counts = [b""], [0]
        self._extend(piece, last, counts)
        return counts

    def _extend(self, piece: bytes, last: list[bytes], counts: list[int]) -> None:
        """Carry the last token and the count at each prefix, known for the first prefixes, on to the end of the pre-token."""
        tokens, fits, reach = self.tokens, self.fits, self.reach
        for end in range(len(last), len(piece) + 1):
            for start in range(max(0, end - reach.get(piece[end - 3 : end], 2) if end > 2 else 0), end):
                token = piece[start:end]
                if token in tokens:
                    if start == 0:
                        break
                    fit = fits.get((last[start], token))
                    if fit if fit is not None else self._fit(last[start], token):
                        break
            last.append(token)
            counts.append(counts[start] + 1)

    def count_all(self, pieces: list[bytes]) -> Iterator[int]:
        """Token counts of sorted pre-tokens: what two in a row begin with in common is gone through once."""
        before, last, counts = b"", [b""], [0]
        for piece in pieces:
            same = 0
            for x, y in zip(before, piece):  # noqa: B905
                if x != y:
                    break
                same += 1
            del last[same + 1 :], counts[same + 1 :]
            self._extend(piece, last, counts)
            before = piece
            yield counts[-1]

    def sections(self, text: str) -> list[tuple[str, bool]]:
        """Stretches of ordinary text and, flagged, added tokens."""
        if self.split is None or not any(a in text for a in self.added):
            return [(text, False)]
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [(text[at : m.start()], False), (m.group(), True)]
            at = m.end()
        return [*out, (text[at:], False)]

    def total(self, text: str) -> int:
        return self.measure(text, None)[0]

    def prefix_counts(self, text: str) -> list[int]:
        """Token count at every byte of the text, entry 0 first; inside an added token, that of its start."""
        out = [0]
        for part, added in self.sections(text):
            if added:
                out += [out[-1]] * (len(part.encode()) - 1) + [out[-1] + 1]
                continue
            for piece in self.pattern.findall(part):
                base = out[-1]
                out += [base + c for c in self.row(piece.encode())[1:]]
        return out

    def within(self, text: str, budget: int) -> int:
        """Bytes of the longest prefix of at most ``budget`` tokens."""
        cut = self.measure(text, budget)[1]
        return len(text.encode()) if cut is None else cut

    def measure(self, text: str, budget: int | None) -> tuple[int, int | None]:
        """Tokens, and the bytes of the longest prefix of at most ``budget`` tokens if the text has more."""
        return self.measure_all([text], budget)[0]

    def measure_all(self, texts: list[str], budget: int | None) -> list[tuple[int, int | None]]:
        """``measure`` of some texts. Each is cut into pre-tokens once, and those not met before are counted together."""
        cut = [[([part] if added else self.pattern.findall(part), added) for part, added in self.sections(text)] for text in texts]
        self.known.fill({piece for text in cut for pieces, added in text if not added for piece in pieces})
        return [self._measured(text, budget) for text in cut]

    def _measured(self, text: list[tuple[list[str], bool]], budget: int | None) -> tuple[int, int | None]:
        used, cut, before = 0, None, 0  # ``before``: bytes of the sections done
        for pieces, added in text:
            totals = [1] if added else list(map(self.known.__getitem__, pieces))
            more = sum(totals)
            if budget is not None and cut is None:
                if used + more > budget:
                    sums = list(accumulate(totals, initial=used))
                    i = bisect_right(sums, budget) - 1  # pre-tokens that fit
                    cut = before + len("".join(pieces[:i]).encode())
                    if not added:
                        row = self.row(pieces[i].encode())
                        cut += max(j for j, c in enumerate(row) if sums[i] + c <= budget)
                else:
                    before += len("".join(pieces).encode())
            used += more
        return used, cut


class _Known(dict):
    """Token count of each pre-token met lately: when it is full, what it held stays at hand until it is full again."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter
        self.older: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        self.fill({piece})
        return self[piece]

    def fill(self, pieces: set[str]) -> None:
        """Make the counts of pre-tokens known, all of them at hand afterwards."""
        if len(self) >= MOST_KEPT // 2:
            self.older = dict(self)
            self.clear()
        fresh = []
        for piece in pieces.difference(self):
            n = self.older.get(piece)
            if n is None:
                fresh.append(piece.encode())
            else:
                self[piece] = n
        fresh.sort()
        tokens = self.counter.tokens
        self.update((raw.decode(), 1) for raw in fresh if raw in tokens)
        longer = [raw for raw in fresh if raw not in tokens]
        self.update(zip((raw.decode() for raw in longer), self.counter.count_all(longer), strict=True))


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per file and Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_bytes long"


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit, and the bytes of the longest prefix within the limit."""

    def f(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        c = counter(path)
        tokens, cuts = [], []
        sizes, texts = batch.column("n_bytes").to_numpy(), batch.column("text")
        first, ends = 0, np.cumsum(sizes)
        while first < len(sizes):
            base = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, base + AT_ONCE, side="right")), first + 1)
            for n, cut in c.measure_all(texts.slice(first, last - first).to_pylist(), limit):
                cuts.append(int(sizes[len(tokens)]) if cut is None else cut)
                tokens.append(n)
            first = last
        return [pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64()),
             pa.array([n > limit for n in tokens], pa.bool_()), pa.array(cuts, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_bytes"])]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.octet_length(text_or_empty()).cast("long").alias("n_bytes"))
    return map_batches(rows, f, RESULT)
