"""Exact per-group percentiles without gathering a group in one task.

``percentile_disc`` / ``median`` keep every distinct value of a group in
one aggregation buffer. Here all steps read one table of counted values
(group, value, count), and each narrows where the target rank lies:

1. Values fall into bins that grow with their size (``BINS_PER_OCTAVE``
   for each doubling, zero and the signs apart); a running sum over a group's bins finds the
   bin that holds the rank.
2. That bin's range is cut into ``SLICES`` equal slices, and again the
   running sum finds the slice.
3. The distinct values of that slice are ranked.

What a task sees of a group at a time is bounded by the numbers, not by the data: a
doubling holds 2**52 doubles, so a bin some 2**39, and a slice at most 2**20 of them,
whatever values a table has.

``shared`` lets all readers reuse the exchange of the counted table. Every step is an aggregate, a join on the group and a window: exact, lazy, and the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 1 << 13
SLICES = 1 << 20
#: Distance of the bins of positive and negative values from zero: more than any exponent has bins.
_FAR = 1 << 25


def shared(counted: DataFrame, keys: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """``counted`` (an aggregate by ``keys`` and others) for several readers: keys, and numbers as doubles.

    The numbers pass through ``explode`` as one array. So neither the columns that a reader leaves out nor its filters on
    numbers change what lies below, and the aggregate's exchange is the same for all: computed once, reused.
    """
    packed = counted.select(*keys, F.explode(F.array(F.array(*(F.col(c).cast("double") for c in numbers)))).alias("_numbers"))
    return packed.select(*keys, *(F.col("_numbers")[i].alias(c) for i, c in enumerate(numbers)))


def _bin(v: Column) -> Column:
    """Bin number, never falling as ``v`` rises; NaN is above everything, as Spark sorts it."""
    size = F.abs(v)
    place = F.when(size == float("inf"), F.lit(_FAR)).otherwise(F.floor(F.log2(size) * BINS_PER_OCTAVE)) + 2 * _FAR
    return F.when(F.isnan(v), F.lit(5 * _FAR)).when(v == 0, F.lit(0)).when(v > 0, place).otherwise(-place).cast("long")


def _picked(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of ``counts`` (per ``keys``, ordered) whose running ``_c`` reaches ``_k``; ``_k`` becomes the rank inside it."""
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    held = counts.withColumn("_upto", upto).where((F.col("_k") <= F.col("_upto")) & (F.col("_k") > F.col("_upto") - F.col("_c")))
    return held.withColumn("_k", F.col("_k") - (F.col("_upto") - F.col("_c"))).drop("_upto", "_c")


def _within(counted: DataFrame, picked: DataFrame, g: list[str]) -> DataFrame:
    """The counted values of the picked ranges, each with what its range knows."""
    renamed = picked.select(*(F.col(c).alias(f"_p{c}") if c in g else F.col(c) for c in picked.columns))
    condition = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    for k in g:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_p{k}"))
    return counted.join(renamed, condition).drop(*(f"_p{k}" for k in g))


def percentile_of_counts(counted: DataFrame, keys: Sequence[str], value: str, count: str, p: float = 0.5, interpolate: bool = False, alias: str = "percentile") -> DataFrame:
    """(keys..., alias): ``exact_percentile`` of a table that has each group's values with their counts (a value may have several rows)."""
    keys = list(keys)
    g = [f"_g{i}" for i in range(len(keys))]
    v = F.col("_v")
    rows = counted.select(*(F.col(k).alias(x) for k, x in zip(keys, g)), F.col(value).cast("double").alias("_v"), F.col(count).cast("long").alias("_c"))
    rows = rows.where(v.isNotNull() & (F.col("_c") > 0))

    bins = rows.groupBy(*g, _bin(v).alias("_b")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    n = F.sum("_c").over(Window.partitionBy(*g))
    if interpolate:
        position = (n - 1).cast("double") * F.lit(p)
        ranks, weight = [F.floor(position) + 1, F.ceil(position) + 1], position - F.floor(position)
    else:
        ranks, weight = [F.greatest(F.lit(1).cast("long"), F.ceil(n.cast("double") * F.lit(p)))], F.lit(0.0)
    upto = F.sum("_c").over(Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.select("*", upto.alias("_upto"), weight.alias("_w"), F.array(*(F.struct(F.lit(i).alias("side"), r.cast("long").alias("k")) for i, r in enumerate(ranks))).alias("_r"))
    held = F.filter("_r", lambda r: (r["k"] <= F.col("_upto")) & (r["k"] > F.col("_upto") - F.col("_c")))
    bins = bins.withColumn("_r", F.explode(held))
    picked = bins.select(*g, F.col("_r.side").alias("_side"), (F.col("_r.k") - F.col("_upto") + F.col("_c")).alias("_k"), "_lo", "_hi", "_w")

    own = [*g, "_side"]
    spread = F.col("_hi") - F.col("_lo")
    place = F.when(spread > 0, F.least(F.floor((v - F.col("_lo")) / spread * SLICES), F.lit(SLICES - 1))).otherwise(0).cast("long")
    sliced = _within(rows, picked, g).withColumn("_s", place)
    # k and w are the same in all rows of a range, so they are grouping keys
    slices = sliced.groupBy(*own, "_k", "_w", "_s").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    picked = _picked(slices, own, "_s").drop("_s")

    last = _within(rows, picked, g).groupBy(*own, "_k", "_w", "_v").agg(F.sum("_c").alias("_c"))
    picks = _picked(last, own, "_v")
    low_v, high_v = F.max(F.when(F.col("_side") == 0, v)), F.max(F.when(F.col("_side") == len(ranks) - 1, v))
    w = F.max("_w")
    result = F.when(low_v == high_v, low_v).otherwise((1 - w) * low_v + w * high_v)
    return picks.groupBy(*g).agg(result.alias(alias)).select(*(F.col(x).alias(k) for x, k in zip(g, keys)), alias)


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float = 0.5,
    interpolate: bool = False,
    alias: str = "percentile",
) -> DataFrame:
    """(keys..., alias): exact percentile of ``value`` per group, nulls ignored.

    ``interpolate=False`` returns an element (``percentile_disc``; for
    p = 0.5 the lower middle value). ``interpolate=True`` interpolates
    linearly between the two neighbouring elements, as ``percentile`` /
    ``median`` do. Null grouping keys form a group, as in ``groupBy``; a
    group without values has no row. Without keys there is one row, null
    for an empty input.
    """
    keys = list(keys)
    g = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(x) for k, x in zip(keys, g)), F.col(value).cast("double").alias("_value"))
    counted = shared(rows.where(F.col("_value").isNotNull()).groupBy(*g, "_value").agg(F.count(F.lit(1)).alias("_count")), g, ["_value", "_count"])
    found = percentile_of_counts(counted, g, "_value", "_count", p, interpolate, alias)
    return found.select(*(F.col(x).alias(k) for x, k in zip(g, keys)), alias)
