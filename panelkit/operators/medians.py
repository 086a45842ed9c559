"""Exact medians of any number of values (C3) in bounded memory.

``percentile`` keeps every distinct value of a group in one task. Here only
groups of at most ``limit`` values go that way; for larger ones the wanted
ranks are selected by narrowing: each pass counts, for every (group, column,
rank) at once, the values below, at and inside a bracket and takes a quantile
sketch of the inside, whose splitters next to the rank are the next bracket.
A pass leaves some 1/200 of the values, whatever their distribution; values
tied at a bound are counted there and leave the inside, so ties end the search
instead of holding it up. All counts are exact: if a sketch misses the rank,
the next bracket is the side of the old one where the rank lies.

Nulls are left out (a group without values has no median); NaN is the largest
value, as in ``percentile``; of an even number of values, the mean of the two
middle ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage

LIMIT = 100_000     # distinct values a task may keep for one group
GRID = 1000         # splitters a pass
_KEYS = ["_c", "_k"]


def _narrow(values: DataFrame, state: DataFrame, group: list[str], grid: int) -> DataFrame:
    """One pass. ``state``: group, _c, _k (rank from 1), lo and hi (the bracket),
    olo and ohi (the bracket before), value (null while open)."""
    v, lo, hi = F.col("_v"), F.col("lo"), F.col("hi")
    on = [*group, "_c"]
    rows = values.join(state.filter("value IS NULL").drop("value"), on=on, how="inner")
    key = [*group, *_KEYS, "lo", "hi", "olo", "ohi"]
    probs = [i / grid for i in range(grid + 1)]
    inside = (v > lo) & (v < hi)
    got = rows.groupBy(*key).agg(
        F.count(F.when(v < lo, 1)).alias("below"), F.count(F.when(v == lo, 1)).alias("at_lo"),
        F.count(F.when(inside, 1)).alias("inner"),
        F.count(F.when((v == hi) & (hi > lo), 1)).alias("at_hi"),
        F.percentile_approx(F.when(inside, v), probs, 10 * grid).alias("q"))
    k = F.col("_k")
    r = k - F.col("below") - F.col("at_lo")                    # rank inside, from 1
    at = F.floor(r / F.greatest(F.col("inner"), F.lit(1)) * grid).cast("int")
    left, right = k <= F.col("below"), r > F.col("inner") + F.col("at_hi")
    value = (F.when(left | right, F.lit(None)).when(r <= 0, lo).when(r > F.col("inner"), hi)).cast("double")
    low = F.element_at("q", F.greatest(at - 1, F.lit(1)))
    high = F.element_at("q", F.least(at + 4, F.lit(grid + 1)))
    pick = lambda a, b, c: F.when(left, a).when(right, b).otherwise(c)
    return got.select(*group, *_KEYS, pick(F.col("olo"), hi, low).alias("lo"), pick(lo, F.col("ohi"), high).alias("hi"),
                      pick(F.col("olo"), hi, lo).alias("olo"), pick(lo, F.col("ohi"), hi).alias("ohi"),
                      value.alias("value"))


def large_medians(values: DataFrame, sizes: DataFrame, group: list[str], grid: int = GRID) -> DataFrame:
    """Medians of the groups in ``sizes`` (group, _c, n, lo, hi): group, _c, med."""
    ranks = F.array_distinct(F.array(F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")))
    state = cut_lineage(sizes.select(*group, "_c", F.explode(ranks).alias("_k"), "lo", "hi", F.col("lo").alias("olo"),
                                     F.col("hi").alias("ohi"), F.lit(None).cast("double").alias("value")))
    done = []
    while not state.isEmpty():
        state = cut_lineage(_narrow(values, state, group, grid))
        done.append(state.filter("value IS NOT NULL"))
        state = state.filter("value IS NULL")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    low, high = F.min_by("value", "_k"), F.max_by("value", "_k")
    return found.groupBy(*group, "_c").agg(F.when(low == high, low).otherwise(low * 0.5 + high * 0.5).alias("med"))


def medians(df: DataFrame, columns: list[str], group: list[str] = [], limit: int = LIMIT,
            grid: int = GRID) -> DataFrame:
    """Group columns and ``_med_<column>``: the exact median of every column.
    Without ``group`` one row over the whole table (empty table: nulls); groups
    without any value give no row, nor does the null group."""
    g = [f"_g{i}" for i in range(len(group))]
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v"))
                                for i, c in enumerate(columns)]))
    values = df.select(*[F.col(c).alias(a) for c, a in zip(group, g)], pairs.alias("_x")) \
        .select(*g, "_x.*").filter("_v IS NOT NULL")
    if group:  # no median is looked up for a null group
        values = values.na.drop(subset=g)
    sizes = values.groupBy(*g, "_c").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    large = cut_lineage(sizes.filter(F.col("n") > limit))
    if large.isEmpty():
        small = values
        found = None
    else:
        small = values.join(large.select(*g, "_c"), on=[*g, "_c"], how="left_anti")
        found = large_medians(values, large, g, grid)
    meds = small.groupBy(*g, "_c").agg(F.percentile("_v", 0.5).alias("med"))
    meds = meds if found is None else meds.unionByName(found)
    out = meds.groupBy(*g).agg(*[F.max(F.when(F.col("_c") == i, F.col("med"))).alias(f"_med_{c}")
                                 for i, c in enumerate(columns)])
    return out.select(*[F.col(a).alias(c) for c, a in zip(group, g)], *[f"_med_{c}" for c in columns])
