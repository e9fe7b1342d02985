"""Texts that the tests of the operators share: empty, long, repeated, odd bytes, and rows with clashing column names."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row long, score double, chunk string, sequence long, place string"
TEXTS = [
    None, "", " ", "  ", "\n", "a", "A b.C", " lead", "trail ", "trail  ", "two  spaces   three", "tab\tnew\n line \n\n next\r\n  end\x0b\x0c!\x0b?",
    "don't we'll IT'S <|endoftext|> x<|startoftext|>y <s> </s> <0x41>", "déjà vu ß 漢字かな \U0001F600 ١٢٣ ǅ İ ſ K", "lower▁one eighth", "nb sp　wide em",
    "é ́x é", "nul\x00byte \x1c \x1f x", "same text here", "same text here", "x" * 5000, "word " * 9000, "fi ﬁ ™ ½", "--!! ;; ++", "1234567890 " * 40,
    "᠎a ​ b ﻿ c",
]


def texts() -> list[str | None]:
    r = random.Random(5)
    prose = lambda n: " ".join("".join(r.choice("abcdeéÜ.,'9") for _ in range(r.randint(1, 9))) for _ in range(n))
    return TEXTS + [prose(r.choice([3, 30, 300])) for _ in range(60)] + [prose(30_000), "the end of it all " * 4000]


def table(spark, rows: list[str | None]):
    """The texts by number, one null id, and further columns whose names the operators use themselves."""
    data = [(i, t, "en", "s", 1, 7, 0.5, "c", 3, "p") for i, t in enumerate(rows)] + [(None, "a b", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, COLUMNS).repartition(3)
