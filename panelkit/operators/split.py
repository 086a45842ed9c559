"""Ordered holdout (I1), hash samples (H2, I2) and exact k-th key selection.

A global ``row_number()`` over all rows runs in one task. Instead the k-th
key of a total order is found by range partitioning: per-range counts (one
small row per range) locate the range holding row k, the search narrows to
that range and repeats until it is small. The split itself is then a plain
predicate on the key, evaluated in the scan stage.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.operators.panel import PanelSpec

# Below this many rows the final pick is a bounded top-k (TakeOrderedAndProject).
FINAL_PICK_ROWS = 200_000


def _key(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def _final_pick(cur: DataFrame, order: list[str], target: int) -> tuple:
    """The target-th row of a small candidate set: a bounded top-k, then its last row."""
    top = cur.orderBy(*order).limit(target)
    row = top.orderBy(*[F.col(c).desc() for c in order]).limit(1).collect()[0]
    return tuple(row[c] for c in order)


def kth_key(df: DataFrame, order: list[str], k: int, ranges: int | None = None,
            known_count: int | None = None) -> tuple:
    """Values of ``order`` on the k-th row (1-based) of ``df`` sorted by ``order``.

    ``order`` must be unique per row. Each round costs one range-partitioned
    aggregate whose result has ``ranges`` rows; rounds shrink the candidate
    set by about ``ranges``x. A known small row count skips straight to the
    bounded final pick.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    cur = df.select(*order)
    if known_count is not None and known_count <= FINAL_PICK_ROWS:
        return _final_pick(cur, order, k)
    # several rounds read the candidate keys: materialise them once in the
    # shared checkpoint folder instead of re-running their lineage per round
    cur = cut_lineage(cur)
    spark = df.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    target = k
    while True:
        parts = cur.repartitionByRange(ranges, *order)
        stats = (parts.groupBy(F.spark_partition_id().alias("pid"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(_key(order)).alias("lo"),
                      F.max(_key(order)).alias("hi"))
                 .collect())
        stats.sort(key=lambda r: tuple(r["lo"]))
        total = sum(r["n"] for r in stats)
        if target > total:
            raise ValueError(f"k={k} exceeds the row count")
        before = 0
        for r in stats:
            if before + r["n"] >= target:
                chosen = r
                break
            before += r["n"]
        target -= before
        lo, hi = tuple(chosen["lo"]), tuple(chosen["hi"])
        key = _key(order)
        cur = cur.filter((key >= F.struct(*[F.lit(v) for v in lo])) &
                         (key <= F.struct(*[F.lit(v) for v in hi])))
        if chosen["n"] <= FINAL_PICK_ROWS or chosen["n"] == total:
            return _final_pick(cur, order, target)


def weighted_select(weights: DataFrame, order: list[str], weight: str, k_of_total,
                    ranges: int | None = None) -> tuple[tuple, int, int, int]:
    """Find the row of a (key, weight) table where the running weight, in key
    order, first reaches k = ``k_of_total(total)``.

    Returns (key, weight before that row, its weight, k). The table is one
    row per key (e.g. rows per entity); while it has more than
    ``FINAL_PICK_ROWS`` rows it is narrowed by range partitioning with
    per-range weight sums, so nothing unbounded reaches the driver.
    """
    spark = weights.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    cur = weights.select(*order, weight)
    small = cur.limit(FINAL_PICK_ROWS + 1).collect()
    offset = 0
    k = None
    if len(small) > FINAL_PICK_ROWS:
        cur = cut_lineage(cur)  # rounds below re-read it; do not recompute its lineage
    while len(small) > FINAL_PICK_ROWS:
        stats = (cur.repartitionByRange(ranges, *order)
                 .groupBy(F.spark_partition_id().alias("pid"))
                 .agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("n"),
                      F.min(_key(order)).alias("lo"), F.max(_key(order)).alias("hi"))
                 .collect())
        stats.sort(key=lambda r: tuple(r["lo"]))
        if k is None:
            k = k_of_total(sum(r["w"] for r in stats))
        before = offset
        for r in stats:
            if before + r["w"] >= k:
                chosen = r
                break
            before += r["w"]
        offset = before
        key = _key(order)
        cur = cur.filter((key >= F.struct(*[F.lit(v) for v in chosen["lo"]])) &
                         (key <= F.struct(*[F.lit(v) for v in chosen["hi"]])))
        small = cur.limit(FINAL_PICK_ROWS + 1).collect() if chosen["n"] <= FINAL_PICK_ROWS else [None] * (FINAL_PICK_ROWS + 1)
        if chosen["n"] == sum(r["n"] for r in stats):
            small = cur.collect()
            break
    small.sort(key=lambda r: tuple(r[c] for c in order))
    if k is None:
        k = k_of_total(sum(r[weight] for r in small))
    run = offset
    for r in small:
        if run + r[weight] >= k:
            return tuple(r[c] for c in order), run, r[weight], k
        run += r[weight]
    raise ValueError("k exceeds the total weight")


def key_at_most(order: list[str], key: tuple) -> Column:
    """Lexicographic ``(a, b, ...) <= key`` as plain predicates (pushdown friendly)."""
    cond = None
    for i in range(len(order) - 1, -1, -1):
        c, v = F.col(order[i]), F.lit(key[i])
        if cond is None:
            cond = c <= v
        else:
            cond = (c < v) | ((c == v) & cond)
    return cond


def train_size(n: int, test_fraction: float = 0.2) -> int:
    """Rows in train when test takes ceil(test_fraction * n) (sklearn's rule),
    computed in exact decimal arithmetic."""
    f = Fraction(str(test_fraction))
    return n - math.ceil(f * n)


def train_size_floor(n: int, train_fraction: float = 0.8) -> int:
    """Rows in train as floor(train_fraction * n) (the forecasting split)."""
    return math.floor(Fraction(str(train_fraction)) * n)


def split_key(df: DataFrame, spec: PanelSpec, test_fraction: float = 0.2,
              n_train: int | None = None, train_fraction: float | None = None) -> tuple | None:
    """Key (entity, order...) of the last training row, or None if train is empty.

    One partially aggregated pass counts rows per entity; the entity holding
    row k is found on that (one row per entity) table, then the k-th row
    inside it -- never a global sort of the rows.
    """
    counts = df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("_n"))

    def k_of(total: int) -> int:
        if n_train is not None:
            return n_train
        if train_fraction is not None:
            return train_size_floor(total, train_fraction)
        return train_size(total, test_fraction)

    if n_train is not None and n_train <= 0:
        return None
    try:
        ent, before, n_ent, k = weighted_select(counts, [spec.entity], "_n", k_of)
    except ValueError:
        return None
    if k <= 0:
        return None
    inner = kth_key(df.filter(F.col(spec.entity) == F.lit(ent[0])), list(spec.order), k - before,
                    known_count=n_ent)
    return (ent[0], *inner)


def ordered_split(df: DataFrame, spec: PanelSpec, test_fraction: float = 0.2,
                  by_entity: bool = False, n_train: int | None = None,
                  train_fraction: float | None = None) -> tuple[DataFrame, DataFrame]:
    """First rows in (entity, order) order are train, the rest test.

    Train size is n - ceil(test_fraction * n) (or ``n_train``, or
    floor(train_fraction * n)). ``by_entity`` keeps the entity holding the
    cut wholly in train. Both sides are plain filters on the input.
    """
    order = [spec.entity, *spec.order]
    key = split_key(df, spec, test_fraction, n_train, train_fraction)
    if key is None:
        return df.limit(0), df
    cond = (F.col(spec.entity) <= F.lit(key[0])) if by_entity else key_at_most(order, key)
    return df.filter(cond), df.filter(~cond)


def split_flag(df: DataFrame, spec: PanelSpec, test_fraction: float = 0.2,
               n_train: int | None = None, name: str = "is_train") -> DataFrame:
    order = [spec.entity, *spec.order]
    key = split_key(df, spec, test_fraction, n_train)
    if key is None:
        return df.withColumn(name, F.lit(False))
    return df.withColumn(name, key_at_most(order, key))


def hash_key(cols: list[str], name: str = "_hk") -> Column:
    """md5 of the key columns joined with '-': a seed-free, stable sort key."""
    return F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in cols])).alias(name)


HEX_STEP = 3  # hex digits per histogram level: 4096 buckets


def _hex_select(df: DataFrame, key: str, k: int, hist: list | None = None) -> str:
    """The k-th smallest value of a uniformly distributed hex key column.

    Histogram refinement: count rows per leading-hex bucket (at most 4096
    rows reach the driver), keep the bucket holding row k, extend the
    prefix, repeat; the last bucket is small and picked exactly. A first
    level histogram may be passed in.
    """
    prefix = ""
    target = k
    cur = df.select(key)
    while True:
        if hist is None:
            b = F.substring(F.col(key), 1, len(prefix) + HEX_STEP)
            hist = cur.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        hist = sorted(hist, key=lambda r: r["b"])
        before = 0
        for r in hist:
            if before + r["n"] >= target:
                chosen = r
                break
            before += r["n"]
        else:
            raise ValueError("k exceeds the row count")
        target -= before
        prefix = chosen["b"]
        cur = cur.filter(F.col(key).startswith(prefix))
        hist = None
        if chosen["n"] <= FINAL_PICK_ROWS or len(prefix) >= 32:
            return _final_pick(cur, [key], target)[0]
        # another level follows: keep only this bucket's keys, materialised
        cur = cut_lineage(cur)


def hash_first(df: DataFrame, key_cols: list[str], n: int) -> DataFrame:
    """H2: deterministic 'first n rows' = the n smallest md5 keys (any n).

    The first-level key histogram also gives the row count (one job)."""
    if n <= 0:
        return df.limit(0)
    keyed = df.withColumn("_hk", hash_key(key_cols))
    hist = keyed.groupBy(F.substring("_hk", 1, HEX_STEP).alias("b")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    if n >= sum(r["n"] for r in hist):
        return keyed.drop("_hk")
    cut = _hex_select(keyed, "_hk", n, hist)
    return keyed.filter(F.col("_hk") <= F.lit(cut)).drop("_hk")


def balanced_sample(df: DataFrame, key_cols: list[str], label: str = "sepsislabel",
                    ratio: int = 3) -> DataFrame:
    """All positives plus the ``ratio * n_pos`` negatives with the smallest
    md5 key (all negatives if fewer exist).

    One aggregate gives the positive count and the negatives' first-level
    key histogram; a second, filtered pass picks the exact cut. The sample is
    then a plain filter -- no global window, no row order dependence.
    """
    keyed = df.withColumn("_hk", hash_key(key_cols))
    b = F.substring(F.col("_hk"), 1, HEX_STEP)
    hist = keyed.groupBy(F.col(label).alias("_l"), b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    n_pos = sum(r["n"] for r in hist if r["_l"] == 1)
    neg_hist = sorted((r for r in hist if r["_l"] == 0), key=lambda r: r["b"])
    n_neg = sum(r["n"] for r in neg_hist)
    take = ratio * n_pos
    is_pos = F.col(label) == 1
    if take >= n_neg:
        return df.filter(is_pos | (F.col(label) == 0))
    if take <= 0:
        return df.filter(is_pos)
    before = 0
    for r in neg_hist:
        if before + r["n"] >= take:
            chosen = r
            break
        before += r["n"]
    negs = keyed.filter((F.col(label) == 0) & F.col("_hk").startswith(chosen["b"]))
    cut = (_final_pick(negs.select("_hk"), ["_hk"], take - before)[0] if chosen["n"] <= FINAL_PICK_ROWS
           else _hex_select(negs, "_hk", take - before, None))
    keep = is_pos | ((F.col(label) == 0) & (F.col("_hk") <= F.lit(cut)))
    return keyed.filter(keep).drop("_hk")
