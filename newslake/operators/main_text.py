"""The main text of pages without a known class, by text and link density.

A block is the text between two starts or ends of block elements (``functions/markup.py``).

* *Score.* 100 * own * own / words, where own words are those outside links: long texts score high, menus nothing. A
  score is smoothed with its neighbours, half its own and a quarter of each, so a short paragraph between long ones holds.
* *Container.* Each block gives its smoothed score to the element it stands in and half of it to the one above; ``article``
  and ``main`` count double. The element with the highest sum holds the body, the first one if several have it.
* *Cut.* Inside the container, blocks with at most half of their words in links are kept. Elsewhere a block needs a
  smoothed score of the container's mean as well, and nothing counts if the container is an ``article`` or ``main``, by which
  the page itself says where its body is. Blocks within ``nav``, ``footer``, ``aside`` or ``form`` never count.

All scores are whole numbers, so the result does not depend on the order of sums. Pages without text give an empty body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.html import with_page

PREFERRED = ("article", "main")


def _own(block: Column) -> Column:
    """As a long: the square of a block's words is beyond an int from 4,634 words on."""
    return block["words"].cast("long") - block["link_words"]


def _whole(value: Column) -> Column:
    return F.floor(value).cast("long")


def with_blocks(pages: DataFrame) -> DataFrame:
    """Add ``_blocks``: the blocks with ``place`` and smoothed ``score``, zero where they never count."""
    raw = F.transform("_page.blocks", lambda b: F.when(b["beside"], F.lit(0).cast("long")).otherwise(_whole(100 * _own(b) * _own(b) / b["words"])))
    scored = with_page(pages).withColumn("_raw", raw)

    def smoothed(block: Column, i: Column) -> Column:
        near = F.coalesce(F.get("_raw", i - 1), F.lit(0)) + F.coalesce(F.get("_raw", i + 1), F.lit(0))
        score = F.when(block["beside"], F.lit(0).cast("long")).otherwise(_whole((2 * F.get("_raw", i) + near) / 4))
        return F.struct(i.alias("place"), block["text"].alias("text"), block["words"].alias("words"), block["link_words"].alias("link_words"),
                        block["parent"].alias("parent"), block["above"].alias("above"), block["beside"].alias("beside"), score.alias("score"))

    return scored.withColumn("_blocks", F.transform("_page.blocks", smoothed)).drop("_raw")


def with_main_text(pages: DataFrame, key: str, name: str = "content") -> DataFrame:
    """Add the main text, its blocks joined by line breaks, and ``n_blocks``, how many they are.

    ``pages`` has ``html`` and a unique ``key``. Scores are summed per (page, element) in a hash aggregate, so a page of any
    number of blocks costs no more than its size.
    """
    made = with_blocks(pages)
    blocks = made.select(key, F.posexplode("_page.elements.tag").alias("element", "tag")).where(F.col("tag").isin(*PREFERRED))
    preferred = blocks.select(key, "element", F.lit(2).alias("times"))
    listed = made.select(key, F.explode("_blocks").alias("b")).where("not b.beside")
    given = listed.select(key, F.explode(F.array(
        F.struct(F.col("b.parent").alias("element"), (2 * F.col("b.score")).alias("points")),
        F.struct(F.col("b.above").alias("element"), F.col("b.score").alias("points")))).alias("g")).select(key, "g.*")
    sums = given.groupBy(key, "element").agg(F.sum("points").alias("points")).join(preferred, [key, "element"], "left")
    # The most points, then the first element: both in one number, so that the aggregate needs no sort.
    ranked = (F.col("points") * F.coalesce("times", F.lit(1))).cast("decimal(27,0)") * F.lit(2**31).cast("decimal(10,0)") - F.col("element") - 1
    best = sums.groupBy(key).agg(F.max(ranked).alias("most")).select(key, (F.pmod(-F.col("most"), F.lit(2**31).cast("decimal(10,0)")).cast("int") - 1).alias("_body"))
    chosen = made.join(best, key, "left")
    inside = lambda b: (b["parent"] == F.col("_body")) | (b["above"] == F.col("_body"))
    open_ = lambda b: ~b["beside"] & (2 * b["link_words"] <= b["words"])
    core = F.filter("_blocks", lambda b: open_(b) & inside(b))
    chosen = chosen.withColumn("_cut", _whole(F.aggregate(core, F.lit(0).cast("long"), lambda a, b: a + b["score"]) / F.nullif(F.size(core), F.lit(0))))
    marked = F.coalesce(F.get("_page.elements", F.col("_body"))["tag"].isin(*PREFERRED), F.lit(False))
    chosen = chosen.withColumn("_cut", F.when(~marked, F.col("_cut")))
    kept = F.filter("_blocks", lambda b: open_(b) & (inside(b) | F.coalesce(b["score"] >= F.col("_cut"), F.lit(False))))
    chosen = chosen.withColumn("_kept", F.coalesce(kept, F.slice("_blocks", 1, 0)))
    text = F.coalesce(F.array_join(F.transform("_kept", lambda b: b["text"]), "\n"), F.lit(""))
    return chosen.select(*pages.columns, text.alias(name), F.greatest(F.size("_kept"), F.lit(0)).cast("long").alias("n_blocks"))
