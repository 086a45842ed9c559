"""Projections, predicates (B) and cleaning / imputation (C)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelkit import constants as K
from panelkit.functions.scalar import flag
from panelkit.operators.medians import medians
from panelkit.operators.panel import PanelSpec


# ---------------------------------------------------------------- B: projection

def normalize_columns(df: DataFrame) -> DataFrame:
    """B1: strip and lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """B2: projection in a fixed order (pruned down to the parquet scan)."""
    return df.select(*columns)


def where_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Row predicate ``column == value``."""
    return df.filter(F.col(column) == F.lit(value))


def min_history(df: DataFrame, spec: PanelSpec, min_rows: int,
                how: str = "semi") -> DataFrame:
    """Keep entities with at least ``min_rows`` rows.

    ``semi`` (default): a partially aggregated count per entity, semi-joined
    back (G1); adaptive execution can split a hot entity in the join.
    ``window``: an entity count over the panel window -- no join, and it
    shares the exchange with later per-entity windows, but one entity's rows
    meet in one task.
    """
    if how == "window":
        n = F.count(F.lit(1)).over(spec.group())
        return df.withColumn("_n", n).filter(F.col("_n") >= min_rows).drop("_n")
    keys = (df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_rows).select(spec.entity))
    return df.join(keys, on=spec.entity, how="left_semi")


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """B5."""
    return df.na.drop(subset=subset)


def contains_item(df: DataFrame, column: str, item: str) -> DataFrame:
    """Exact set membership on an item array."""
    return df.filter(F.array_contains(F.col(column), F.lit(item)))


def any_null(columns: list[str]) -> Column:
    """``a IS NULL OR b IS NULL ...``."""
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def complete_record(df: DataFrame) -> DataFrame:
    """Complete partial vitals records the way the scoring form does.

    dbp defaults to map - 10, rolling means to the current value, trends to 0,
    volatilities and the rest to the request defaults, flags are recomputed
    from thresholds and qSOFA from the flags.
    """
    d = K.RECORD_DEFAULTS
    cur = {c: F.coalesce(F.col(c), F.lit(d[c])) for c in ["hr", "o2sat", "temp", "sbp", "map", "resp"]}
    out = {
        **cur,
        "dbp": F.coalesce(F.col("dbp"), cur["map"] - K.DBP_FROM_MAP_OFFSET),
        "age": F.coalesce(F.col("age"), F.lit(d["age"])),
        "gender": F.coalesce(F.col("gender"), F.lit(d["gender"])),
    }
    for name, src, _ in K.ROLLING_MEANS:
        out[name] = F.coalesce(F.col(name), cur[src])
    for name, _ in K.TRENDS:
        out[name] = F.coalesce(F.col(name), F.lit(0.0))
    for name, _, _ in K.ROLLING_STDS:
        out[name] = F.coalesce(F.col(name), F.lit(d[name]))
    out["hours_in_icu"] = F.coalesce(F.col("hours_in_icu"), F.lit(d["hours_in_icu"]))
    for name, src, op, t in K.ALARM_FLAGS:
        out[name] = flag(cur[src], op, t)
    out["qsofa"] = out["flag_tachypnea"] + out["flag_low_bp"]
    keep = [c for c in df.columns if c not in out]
    return df.select(*keep, *[out[c].alias(c) for c in K.FEATURE_COLS])


# ---------------------------------------------------------------- C: cleaning

def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN means missing. Spark orders NaN above every number and lets one
    NaN poison an average, so every floating column is made null-not-NaN."""
    float_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    cols = [c for c in (columns or df.columns) if c in float_cols]
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def forward_fill(c: str, spec: PanelSpec) -> Column:
    """Last non-null value up to the current row."""
    return F.last(F.col(c), ignorenulls=True).over(spec.running())


def backward_fill_leading(c: str, spec: PanelSpec) -> Column:
    """First non-null value of the entity (fills leading gaps after a forward fill)."""
    return F.first(F.col(c), ignorenulls=True).over(spec.whole())


def fill_forward_backward(df: DataFrame, spec: PanelSpec, columns: list[str]) -> DataFrame:
    """Within entity, forward fill, then leading gaps take the first later value.

    Equal to ffill().bfill(): after a forward fill only leading gaps remain,
    and the next later non-null of a leading gap is the entity's first
    non-null. Uses the whole-entity frame, never a per-row following frame.
    """
    repl = {c: F.coalesce(forward_fill(c, spec), backward_fill_leading(c, spec)).alias(c)
            for c in columns}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def fill_forward(df: DataFrame, spec: PanelSpec, columns: list[str]) -> DataFrame:
    """Forward fill only (causal); leading gaps stay null."""
    repl = {c: forward_fill(c, spec).alias(c) for c in columns}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def impute(df: DataFrame, spec: PanelSpec, both_ways: list[str],
           forward_only: list[str]) -> DataFrame:
    """C1 + C2 in one projection (one Window node, one sort)."""
    repl = {c: F.coalesce(forward_fill(c, spec), backward_fill_leading(c, spec)).alias(c)
            for c in both_ways}
    repl.update({c: forward_fill(c, spec).alias(c) for c in forward_only})
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def fill_median(df: DataFrame, columns: list[str], spec: PanelSpec | None = None,
                approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """Remaining nulls take the column median (interpolated, like pandas).

    With ``spec`` the median is per entity, joined back on the entity -- a
    join, unlike a window, lets adaptive execution split a hot entity's rows
    across tasks (skew join). Without ``spec``, one global median per column,
    inlined as literals. Exact medians are selected in bounded memory
    (``medians``); ``approx`` takes ``percentile_approx`` instead.
    """
    if approx:
        meds = df.groupBy(*([spec.entity] if spec else [])).agg(
            *[F.percentile_approx(F.col(c), 0.5, accuracy).alias(f"_med_{c}") for c in columns])
    else:
        meds = medians(df, columns, [spec.entity] if spec else [])
    if spec is not None:
        joined = df.join(meds, on=spec.entity, how="left")
        repl = {c: F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) for c in columns}
        return joined.select(*[repl.get(c, F.col(c)) for c in df.columns])
    row = meds.first()
    repl = {c: F.coalesce(F.col(c), F.lit(row[f"_med_{c}"])).alias(c)
            for c in columns if row is not None and row[f"_med_{c}"] is not None}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def fill_constant(df: DataFrame, value: float = 0.0, columns: list[str] | None = None) -> DataFrame:
    """C4: every remaining null (numeric columns, or ``columns``) becomes ``value``."""
    return df.na.fill(value, subset=columns) if columns else df.na.fill(value)
