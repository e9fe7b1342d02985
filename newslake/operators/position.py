"""Exact running totals and row frames without putting a group on one task.

A plain ``Window.partitionBy(symbol).orderBy(time)`` sends every trade of a symbol
to one task, and one symbol may be all of the table. These operators range
partition instead, so the work is spread whatever the keys look like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.session import in_ranges, settle

BLOCK_ROWS = 1_000_000


def _before_ranges(ranged: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    """Per (key, range): the given measures, of which ``_sum`` is also added up over
    the ranges before. About ranges + keys rows; settled, so that the planner knows
    how small it is and leaves the rows where they are when joining it."""
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, "_range").agg(*measures)
    before = F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
    return settle(sums.withColumn("_before", before), "range-sums")


def _with_ranges(ranged: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Join by range and key; null keys match each other."""
    r, b = ranged.alias("r"), before.alias("b")
    same = F.col("r._range") == F.col("b._range")
    for key in keys:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"b.{key}"))
    return r.join(b, same)


def running_total(
    df: DataFrame, keys: list[str], order: list[str], weight: Column, name: str
) -> DataFrame:
    """Inclusive running sum of ``weight`` per key in the given order.

    1. Sort into ranges of (keys, order). ``order`` must be unique within a key.
    2. Sum per (range, key) and turn it into the total of the ranges before.
    3. Add the running sum inside the (range, key), which is never larger than a
       range.

    The ranges are settled in the shared folder first, because range bounds are
    sampled and must not change between steps 2 and 3.
    """
    ranged = in_ranges(df, *keys, *order).withColumns(
        {"_range": F.spark_partition_id(), "_weight": weight}
    )
    ranged = settle(ranged, "ranges")
    before = _before_ranges(ranged, keys, F.sum("_weight").alias("_sum"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = ranged.withColumn("_inside", F.sum("_weight").over(inside))
    total = F.col("b._before") + F.col("r._inside")
    joined = _with_ranges(counted, before, keys)
    return joined.select(*[f"r.{n}" for n in df.columns], total.alias(name))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Row number from 1 within the key, in the given unique order.

    As ``running_total``, but the ranges are written in order with a row id that
    counts up inside them, so nothing is shuffled or sorted a second time.
    """
    ranged = in_ranges(df, *keys, *order).sortWithinPartitions(*keys, *order)
    ranged = ranged.withColumns(
        {"_range": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}
    )
    ranged = settle(ranged, "ranges")
    before = _before_ranges(
        ranged, keys, F.count("*").alias("_sum"), F.min("_id").alias("_first")
    )
    position = F.col("b._before") + F.col("r._id") - F.col("b._first") + 1
    joined = _with_ranges(ranged, before, keys)
    return joined.select(*[f"r.{n}" for n in df.columns], position.alias(name))


def block_of(position: Column, block_rows: int) -> Column:
    """Number of the block that holds a position counted from 1, without the
    rounding of a division."""
    before = position - 1
    return ((before - before % block_rows) / block_rows).cast("long")


def row_frames(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    preceding: int,
    columns: dict[str, object],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Window functions over the current and up to ``preceding`` earlier rows.

    Rows are numbered, then cut into blocks of ``block_rows``. A row is copied into
    every block whose frames reach back to it, one in most cases and more if ``preceding``
    exceeds a block, so each frame is whole within its block and no window group
    exceeds ``block_rows + preceding``. ``columns`` maps a name to a function of the
    (ordered) block window.
    """
    rows = numbered(df, keys, order, "_pos")
    block = block_of(F.col("_pos"), block_rows)
    homes = F.sequence(block, block_of(F.col("_pos") + preceding, block_rows))
    copies = rows.withColumn("_block", F.explode(homes))
    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    computed = copies.withColumns({name: make(window) for name, make in columns.items()})
    return computed.where(F.col("_block") == block).drop("_pos", "_block")


def percentiles(
    df: DataFrame, keys: list[str], value: str, points: list[float], digits: int = 6
) -> DataFrame:
    """Exact interpolated percentiles per key, one row per (key, point).

    Equal values are counted first; the running count over distinct values then
    tells which two values bracket each point. Nothing is gathered per key. The
    targets are settled so that the planner sees how small they are.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = settle(running_total(counts, keys, [value], F.col("_n"), "_upto"), "ranked")
    totals = ranked.groupBy(*keys).agg(F.max("_upto").alias("_total"))
    targets = totals.withColumn(
        "point", F.explode(F.array(*[F.lit(float(p)) for p in points]))
    ).withColumn("_at", F.col("point") * (F.col("_total") - 1))
    at = ranked.join(settle(targets, "targets"), keys)
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    low, high = F.floor("_at"), F.ceil("_at")
    holds_low = (first <= low) & (low <= last)
    holds_high = (first <= high) & (high <= last)
    bracket = at.where(holds_low | holds_high).groupBy(*keys, "point").agg(
        F.max(F.when(holds_low, F.col(value))).alias("_lo"),
        F.max(F.when(holds_high, F.col(value))).alias("_hi"),
        F.max(F.col("_at") - low).alias("_part"),
    )
    exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    return bracket.select(*keys, "point", F.round(exact, digits).alias("percentile"))
