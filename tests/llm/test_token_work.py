"""How much work a token count takes, and that forgetting changes no result."""

from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from newslake.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


class Spy:
    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def findall(self, text):
        self.calls += 1
        return self.pattern.findall(text)


def texts(n):
    r = random.Random(5)
    word = lambda: "".join(r.choice("theandrsioß") for _ in range(r.randint(1, 14)))
    return [" ".join(word() for _ in range(r.randint(1, 60))) + r.choice(["", "<|endoftext|>tail x", "  \n"]) for _ in range(n)]


def test_texts_over_the_limit_are_cut_once():
    c = token_counts.PrefixCounter(PATH)
    c.pattern = spy = Spy(c.pattern)
    some = ["one two three four", "a b", "five six seven eight nine"]
    got = c.measure_all(some, 3)
    assert spy.calls == len(some)
    assert got == [(4, len("one two three")), (2, None), (5, len("five six seven"))]


def test_forgetting_and_shared_beginnings(monkeypatch):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(token_counts, "MOST_KEPT", 40)
    c = token_counts.PrefixCounter(PATH)
    some = texts(60)
    got = [m for i in range(0, 60, 7) for m in c.measure_all(some[i : i + 7], 30)]
    for text, (n, cut) in zip(some, got, strict=True):
        assert n == len(library.encode(text, add_special_tokens=False).ids) == c.total(text)
        counts = c.prefix_counts(text)
        assert (cut is None) == (n <= 30) and c.within(text, 30) == (len(text.encode()) if cut is None else cut)
        assert cut is None or counts[cut] <= 30 < counts[cut + 1]


def test_pairs_fit_as_plain_merging_says():
    c, r = token_counts.PrefixCounter(PATH), random.Random(2)
    some = r.sample(sorted(c.tokens), 3000)
    for whole, other in zip(some, reversed(some), strict=True):
        i = r.randrange(1, len(whole) + 1)
        for pair in ((whole, other), (whole[:i], whole[i:])):
            if all(p in c.tokens for p in pair):
                assert c._fit(*pair) == (c.merge(pair[0] + pair[1]) == list(pair))
