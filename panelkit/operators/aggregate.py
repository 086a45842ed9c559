"""Aggregations (F). All are hash aggregates with map-side partial
aggregation, so a hot key collapses to one partial row per task before the
shuffle; none holds a group's rows in memory."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import scalar as X
from panelkit.operators.panel import PanelSpec


def entity_profile(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """one row per entity: mean vitals, max flags/label/hours."""
    return features.groupBy(spec.entity).agg(
        F.avg("hr").alias("avg_hr"), F.avg("temp").alias("avg_temp"),
        F.avg("o2sat").alias("avg_o2sat"), F.avg("sbp").alias("avg_sbp"),
        F.avg("map").alias("avg_map"), F.avg("resp").alias("avg_resp"),
        F.max("qsofa").alias("max_qsofa"),
        F.max("flag_tachy").alias("had_tachy"),
        F.max("flag_fever").alias("had_fever"),
        F.max("flag_low_bp").alias("had_low_bp"),
        F.max("flag_hypoxia").alias("had_hypoxia"),
        F.max("sepsislabel").alias("had_sepsis"),
        F.max(spec.order[0]).alias("total_icu_hours"),
    )


def segment_profile(df: DataFrame, segment: str = "cluster", label: str = "sepsislabel") -> DataFrame:
    """per segment mean vitals / flags / outcome rate and row count."""
    return df.groupBy(segment).agg(
        F.avg("hr").alias("avg_hr"), F.avg("temp").alias("avg_temp"),
        F.avg("o2sat").alias("avg_o2sat"), F.avg("map").alias("avg_map"),
        F.avg("resp").alias("avg_resp"), F.avg("qsofa").alias("avg_qsofa"),
        F.avg("flag_tachy").alias("tachy_rate"), F.avg("flag_low_bp").alias("low_bp_rate"),
        F.avg(label).alias("sepsis_rate"), F.count("hr").alias("patient_count"),
    )


def class_counts(df: DataFrame, label: str = "sepsislabel") -> DataFrame:
    """One row: negatives, positives, rows (conditional sums in one pass)."""
    return df.agg(
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("long").alias("neg"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.count(F.lit(1)).alias("n"),
    )


def class_imbalance(df: DataFrame, label: str = "sepsislabel") -> DataFrame:
    """neg, pos and round(neg / pos) half-even (null when no positives)."""
    c = class_counts(df, label)
    return c.select("neg", "pos",
                    F.when(F.col("pos") > 0, F.bround(F.col("neg") / F.col("pos"), 0))
                    .cast("long").alias("ratio"))


def label_distribution(df: DataFrame, label: str = "sepsislabel") -> DataFrame:
    """F4."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))


def value_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """count and percent of all rows per (column, value), one pass.

    ``stack`` unpivots inside the scan stage; partial aggregation reduces it
    to (column, value) pairs; the percent window runs on that small table.
    """
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (`column`, `value`)")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    # per-column totals: one row per column (bounded), broadcast back
    totals = counts.groupBy("column").agg(F.sum("cnt").alias("_total"))
    out = counts.join(F.broadcast(totals), on="column", how="inner")
    return out.select("column", "value", "cnt", (F.col("cnt") * 100.0 / F.col("_total")).alias("pct"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One aggregate row of null counts, returned long as (column, nulls)."""
    cols = columns or df.columns
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (`column`, `nulls`)")


def panel_counts(df: DataFrame, spec: PanelSpec, approx: bool = False) -> DataFrame:
    """rows, distinct entities, min/max rows per entity.

    The distinct count is a two-level aggregate (per-entity partial counts
    first), so a hot entity never concentrates in one task.
    """
    per = df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n"))
    if approx:
        return df.agg(F.count(F.lit(1)).alias("rows"),
                      F.approx_count_distinct(spec.entity).alias("entities"))
    return per.agg(F.sum("n").cast("long").alias("rows"), F.count(F.lit(1)).alias("entities"),
                   F.min("n").alias("min_rows_per_entity"), F.max("n").alias("max_rows_per_entity"))


HLL_LOG2_BUCKETS = 14   # 16,384 buckets, at most some 16 KB a sketch: standard error some 0.8 %


def distinct_sketches(df: DataFrame, column: str, by: list[str], log2_buckets: int = HLL_LOG2_BUCKETS) -> DataFrame:
    """F7, mergeable: per group the row count and a sketch of the distinct
    values of ``column`` (``by``, rows, sketch). Kept as a table, new days are
    appended and no old row is read again. Null values do not count; a group of
    nulls alone has an empty sketch."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               F.hll_sketch_agg(F.col(column), log2_buckets).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: list[str] = []) -> DataFrame:
    """Rows and estimated distinct values of coarser groups (all rows without
    ``by``) from the sketches alone: the union of sketches is the sketch of the
    union, so a value seen on many days counts once."""
    return sketches.groupBy(*by).agg(F.sum("rows").cast("long").alias("rows"),
                                     F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))


def rows_per_entity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("rows"))


def group_separation(df: DataFrame, columns: list[str], label: str = "sepsislabel") -> DataFrame:
    """F8: |mean(class 1) - mean(class 0)| per column, one pass, long output."""
    aggs = []
    for c in columns:
        aggs.append(F.avg(F.when(F.col(label) == 1, F.col(c))).alias(f"{c}__1"))
        aggs.append(F.avg(F.when(F.col(label) == 0, F.col(c))).alias(f"{c}__0"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', abs(`{c}__1` - `{c}__0`)" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (`component`, `separation`)")


def class_weights(df: DataFrame, label: str = "sepsislabel", name: str = "weight",
                  max_classes: int = 1000) -> DataFrame:
    """balanced weights n / (k * count(class)) attached to each row.

    The per-class counts are one partially aggregated pass whose result is
    bounded by the label domain (checked); the weights are then a literal
    lookup, so the rows are neither joined nor shuffled.
    """
    counts = (df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
              .limit(max_classes + 1).collect())
    if len(counts) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label}")
    n, k = sum(r["_c"] for r in counts), len(counts)
    weights = {r[label]: n / (k * r["_c"]) for r in counts if r[label] is not None}
    if not weights:
        return df.withColumn(name, F.lit(None).cast("double"))
    return df.withColumn(name, X.lookup(F.col(label), weights))


def positive_weight(df: DataFrame, label: str = "sepsislabel", name: str = "weight",
                    ratio: float | None = None) -> DataFrame:
    """positives weighted by round(neg/pos) (computed unless given), negatives 1.

    The ratio is one scalar from a single partially-aggregated pass."""
    if ratio is None:
        r = class_imbalance(df, label).first()["ratio"]
        ratio = float(r) if r is not None else 1.0
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def exact_mean(c: str, scale: int = 6) -> Column:
    """Mean of the values at ``scale`` decimals, summed exactly in DECIMAL and
    rounded half-up: independent of partitioning and summation order."""
    return F.round(F.avg(F.col(c).cast(f"decimal(18,{scale})")), scale).cast("double")


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """F11 report: exact mean and population std per column (zero std -> 1), long."""
    aggs = []
    for c in columns:
        aggs += [exact_mean(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s")]
    wide = df.agg(*aggs)
    pairs = ", ".join(
        f"'{c}', `{c}__m`, CASE WHEN `{c}__s` = 0 OR `{c}__s` IS NULL THEN 1D ELSE `{c}__s` END"
        for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (`feature`, `mean`, `std`)")


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, one aggregate pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    body = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {body}) AS (`col_a`, `col_b`, `corr`)")


def covariance_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """population covariance of every pair (including the diagonal)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.covar_pop(a, b).alias(f"{a}__{b}") for a, b in pairs])
    body = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {body}) AS (`col_a`, `col_b`, `cov`)")


def risk_score(flag_cols: list[str] | None = None) -> Column:
    """Deterministic scorer used where a probability is needed without a fit:
    (sum of alarm flags + qSOFA) / (number of flags + 2), in [0, 1]."""
    flags = flag_cols or K.FLAG_COLS
    total = F.lit(0.0)
    for f in flags:
        total = total + F.col(f)
    total = total + F.col("qsofa")
    return total / float(len(flags) + 2)
