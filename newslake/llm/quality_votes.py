"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated without labels.

Every rule says good (1), bad (0) or nothing about a document. Expectation-maximisation over the votes
estimates how often each rule is right when it votes, and the share of good documents; the
posterior of a document, not a count of passed rules, decides. The model: votes are independent given
the truth, and a rule that votes is right with one probability about good documents and with
another about bad ones (a rule may see few of the bad ones and yet hardly ever be wrong about a good one).

The first step takes the share of good ones among a document's votes for its probability, and steps go on until no rate moves by ``CLOSE``; no labels, starting
rates or bounds enter, and one vote each way keeps rates off 0 and 1. ``judge`` estimates over the documents that pass the base rules,
since only these are decided by the posterior; the others, being alike, would else be the class that is found. Where none
passes, or none has a vote, nothing is known and the posterior is one half.

Documents with the same votes have the same posterior, so the steps run on the table of vote
patterns, at most 3 ** rules rows however large the corpus; a few sums reach the driver in each step.

All of it is DataFrame expressions within the row; nothing is exploded or shuffled but the patterns. Repeated
three-word windows are found by sorting 40-bit hash prefixes with positions, and confirmed on the words themselves.
Null text has no words; no words, one word or two have no window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.once import computed_once
from newslake.llm.common import text_or_empty
from newslake.session import settle

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
POSITION_BITS = 24  # positions below 2**24 are packed beside a hash; longer documents sort pairs
CLOSE = 0.003  # the steps end when no rate moves by more
SMOOTH = 1.0  # votes added each way
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_ends"]


def _positions(n: Column) -> Column:
    """0 .. n-1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _neighbours(array: str, same) -> Column:
    """Elements of a sorted array column that equal the one before or behind them, by ``same``."""
    a = F.col(array)
    last = F.size(a) - 1
    return F.transform(
        F.filter(_positions(F.size(a)), lambda k: ((k > 0) & same(F.get(a, k), F.get(a, k - 1))) | ((k < last) & same(F.get(a, k), F.get(a, k + 1)))),
        lambda k: F.get(a, k),
    )


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and the measures the rules use."""
    text = F.col("text")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    df = computed_once(df, "w", F.filter(F.split(text, BLANK), lambda x: x != ""))
    w, n = F.col("w"), F.size("w")
    df = df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
        "n_letters": (F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))).cast("long"),
        "n_ends": F.regexp_count(text, F.lit("[.!?]")).cast("long"),
    })
    df = computed_once(df, "lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumns({"n_lines": F.size("lines").cast("long"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")})
    df = df.drop("lines", "text")
    df = computed_once(df, "h", F.transform(_positions(F.size("w") - 2), lambda i: F.xxhash64(F.get(F.col("w"), i), F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2))))
    h = F.col("h")
    distinct = F.size(F.array_distinct(h)) == F.size(h)
    low = (1 << POSITION_BITS) - 1
    df = computed_once(df, "packed", F.when(
        ~distinct & (F.size(h) <= low), F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(~low).bitwiseOR(i.cast("long"))))
    ).otherwise(F.array().cast("array<long>")))
    df = computed_once(df, "pairs", F.when(F.size(h) > low, F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))
    some = F.transform(_neighbours("packed", lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)), lambda x: x.bitwiseAND(low).cast("int"))
    more = F.transform(_neighbours("pairs", lambda a, b: a["h"] == b["h"]), lambda x: x["i"])
    word = lambda p, k: F.get(F.col("w"), p + k)
    df = computed_once(df.drop("h"), "windows", F.array_sort(F.transform(F.concat(some, more), lambda p: F.struct(
        F.concat_ws(" ", word(p, 0), word(p, 1), word(p, 2)).alias("g"), p.alias("p")))))
    df = computed_once(df.drop("packed", "pairs", "w"), "at", F.sort_array(F.transform(_neighbours("windows", lambda a, b: a["g"] == b["g"]), lambda x: x["p"])))
    at = F.col("at")
    covered = F.aggregate(_positions(F.size(at)), F.lit(0).cast("long"), lambda total, k: total + F.when(
        k + 1 < F.size(at), F.least(F.lit(3), F.get(at, k + 1) - F.get(at, k))).otherwise(3).cast("long"))
    return df.withColumn("n_repeat_words", covered).select("doc_id", *MEASURES)


def rules() -> dict[str, tuple[Column, Column]]:
    """Each rule's conditions for a bad and for a good vote; it abstains where neither holds."""
    c = F.col
    per_char = lambda x: c(x) / c("word_chars")
    per_word = lambda x: c(x) / c("n_words")
    long_enough = c("n_words") >= FEWEST_WORDS
    return {
        "symbols": (per_char("n_symbols") > 0.1, per_char("n_symbols") < 0.02),
        "repeated_windows": (per_word("n_repeat_words") > 0.3, per_word("n_repeat_words") < 0.1),
        "repeated_lines": (c("n_dup_lines") > 0.3 * c("n_lines"), (c("n_dup_lines") == 0) & (c("n_lines") > 1)),
        "word_length": ((per_word("word_chars") < 2) | (per_word("word_chars") > 14), per_word("word_chars").between(3, 10)),
        "upper_case": (c("n_upper") > 0.5 * c("n_letters"), c("n_upper") < 0.2 * c("n_letters")),
        "letters": (per_char("n_letters") < 0.7, per_char("n_letters") > 0.85),
        "sentences": (long_enough & (c("n_ends") == 0), per_word("n_ends").between(0.01, 0.3)),
    }


def voted(df: DataFrame) -> DataFrame:
    """A column per rule: 1, 0 or null. Documents without words get no vote."""
    votes = {f"vote_{k}": F.when(F.col("n_words") > 0, F.when(bad, 0).when(good, 1)) for k, (bad, good) in rules().items()}
    return df.withColumns(votes)


def _log_odds(accuracy: dict[str, tuple[float, float]], prior: float) -> Column:
    total = F.lit(math.log(prior / (1 - prior)))
    for name, (good, bad) in accuracy.items():
        up, down = math.log(good / (1 - bad)), math.log((1 - good) / bad)
        total = total + F.when(F.col(name) == 1, up).when(F.col(name) == 0, down).otherwise(0.0)
    return total


def _posterior(accuracy: dict[str, tuple[float, float]], prior: float) -> Column:
    return 1 / (1 + F.exp(-_log_odds(accuracy, prior)))


def _share(names: list[str]) -> Column:
    """The share of good votes."""
    cast = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    return sum((F.coalesce(n, F.lit(0)) for n in names), F.lit(0)) / cast


def fitted(votes: DataFrame) -> tuple[dict[str, tuple[float, float]], float, int]:
    """How often each rule is right about good and about bad documents, the share of good ones, and the steps it took."""
    names = [f"vote_{k}" for k in rules()]
    patterns = settle(votes.where(F.coalesce(*names).isNotNull()).groupBy(*names).agg(F.count("*").alias("n")), "vote-patterns")
    accuracy, prior, steps, moved = dict.fromkeys(names, (0.5, 0.5)), 0.5, 0, 1.0
    while moved > CLOSE:
        q = _posterior(accuracy, prior) if steps else _share(names)
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * q).alias("good")]
        for name in names:
            for kind, share, vote in (("good", q, 1), ("bad", 1 - q, 0)):
                weight = F.col("n") * share
                sums += [F.sum(F.when(F.col(name) == vote, weight)).alias(f"{name}_{kind}_right"),
                         F.sum(F.when(F.col(name).isNotNull(), weight)).alias(f"{name}_{kind}_cast")]
        row = patterns.agg(*sums).first()
        if not row["n"]:
            break
        rate = lambda part, whole: ((row[part] or 0.0) + SMOOTH) / ((row[whole] or 0.0) + 2 * SMOOTH)
        found = {name: tuple(rate(f"{name}_{kind}_right", f"{name}_{kind}_cast") for kind in ("good", "bad")) for name in names}
        share = rate("good", "n")
        moved = max(abs(share - prior), *(abs(x - y) for name in names for x, y in zip(found[name], accuracy[name], strict=True)))
        accuracy, prior, steps = found, share, steps + 1
    return accuracy, prior, steps


def estimate(votes: DataFrame) -> tuple[dict[str, tuple[float, float]], float]:
    """The rates of the rules and the share of good documents."""
    return fitted(votes)[:2]


def judge(docs: DataFrame) -> DataFrame:
    """Per row: the measures of the text, base_failed, kept, the posterior probability of good quality, and ``steps`` of the estimation."""
    votes = voted(settle(measured(docs), "quality-measures"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    accuracy, prior, steps = fitted(votes.where(~failed))
    posterior = _posterior(accuracy, prior)
    return votes.select("doc_id", *MEASURES[:5], failed.alias("base_failed"), (~failed & (posterior >= 0.5)).alias("kept"), posterior.alias("posterior"),
                        F.lit(steps).cast("long").alias("steps"))
