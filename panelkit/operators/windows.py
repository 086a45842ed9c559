"""Per-entity window operators (D) and the feature table built from them.

All frames are row-based over one ``PanelSpec``; Catalyst places every
expression of a spec into the same Window node after one Exchange + Sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import scalar
from panelkit.operators import clean
from panelkit.operators.panel import PanelSpec


def rolling_mean(c: str, n: int, spec: PanelSpec) -> Column:
    """Mean of the last n rows, nulls skipped, one value suffices."""
    return F.avg(F.col(c)).over(spec.trailing(n))


def rolling_std(c: str, n: int, spec: PanelSpec) -> Column:
    """Sample std of the last n rows; a single value gives 0."""
    return F.coalesce(F.stddev_samp(F.col(c)).over(spec.trailing(n)), F.lit(0.0))


def diff(c: str, spec: PanelSpec, k: int = 1) -> Column:
    """D3: x_t - x_{t-k}; null on the first k rows of an entity."""
    return F.col(c) - F.lag(F.col(c), k).over(spec.ordered())


def lead(c: str, spec: PanelSpec, k: int = 1) -> Column:
    """The value k rows ahead."""
    return F.lead(F.col(c), k).over(spec.ordered())


def ordinal(spec: PanelSpec) -> Column:
    """1-based position in the entity (unique with a tie-breaking order)."""
    return F.row_number().over(spec.ordered())


def lead_target(df: DataFrame, spec: PanelSpec, column: str = "hr",
                name: str = "hr_next_hour", k: int = 1) -> DataFrame:
    """D4 + B5: next-row target; the last row of each entity is dropped."""
    return df.withColumn(name, lead(column, spec, k)).na.drop(subset=[name])


def add_features(df: DataFrame, spec: PanelSpec, hours_col: str | None = None) -> DataFrame:
    """The 19 engineered columns in one projection.

    ``hours_in_icu`` copies ``hours_col`` (default: the spec's order column)."""
    cols = [F.col(c) for c in df.columns]
    cols += [rolling_mean(src, n, spec).alias(name) for name, src, n in K.ROLLING_MEANS]
    cols += [diff(src, spec).alias(name) for name, src in K.TRENDS]
    cols += [rolling_std(src, n, spec).alias(name) for name, src, n in K.ROLLING_STDS]
    cols += scalar.alarm_flags()
    cols.append(scalar.qsofa().alias("qsofa"))
    cols.append(F.col(hours_col or spec.order[0]).alias("hours_in_icu"))
    return df.select(*cols)


def feature_table(panel: DataFrame, spec: PanelSpec,
                  vitals: list[str] | None = None,
                  labs: list[str] | None = None,
                  fill_value: float | None = 0.0) -> DataFrame:
    """Impute (C1 vitals, C2 labs) -> engineered features -> fill 0 (C4).

    Two Window nodes over the same spec: one Exchange on the entity and one
    Sort for the whole chain.
    """
    vitals = vitals if vitals is not None else [c for c in K.VITALS_LC if c in panel.columns]
    labs = labs if labs is not None else [c for c in K.LABS_LC if c in panel.columns]
    imputed = clean.impute(clean.nan_to_null(panel), spec, vitals, labs)
    feats = add_features(imputed, spec)
    return clean.fill_constant(feats, fill_value) if fill_value is not None else feats


def sliding_windows(df: DataFrame, spec: PanelSpec, column: str = "hr",
                    size: int = K.WINDOW_SIZE, as_array: bool = False,
                    ordinal: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every run of ``size`` consecutive rows with the next row as target.

    An entity with n rows yields n - size windows; shorter entities yield none
    (so the min-history filter B4 is implied). Output: entity, order columns
    of the target row, ``lag{size}..lag1`` and ``y`` (or ``window`` array).
    ``ordinal`` names an existing 1-based position column to use instead of
    a row_number (needed when ``spec`` partitions an entity into chunks);
    ``keep`` lists further key columns to carry (e.g. the entity when the
    spec partitions by an entity-chunk key).
    """
    w = spec.ordered()
    lags = [F.lag(F.col(column), i).over(w).alias(f"lag{i}") for i in range(size, 0, -1)]
    pos = F.col(ordinal) if ordinal else F.row_number().over(w)
    extra = [c for c in df.columns if c.startswith("_") and c in ("_halo", "_c2", "_pk2")]
    keys = list(dict.fromkeys([*keep, spec.entity, *spec.order]))
    out = df.select(*keys, *lags, F.col(column).alias("y"), pos.alias("_rn"),
                    *[c for c in extra if c not in keys])
    out = out.filter(F.col("_rn") > size).drop("_rn")
    if as_array:
        lag_names = [f"lag{i}" for i in range(size, 0, -1)]
        out = out.select(*keys, *[c for c in extra if c not in keys],
                         F.array(*lag_names).alias("window"), "y")
    return out


def window_summary(lag_cols: list[str]) -> list[Column]:
    """Mean, population std (about the mean) and last - first of the lags."""
    n = float(len(lag_cols))
    mean = sum((F.col(c) for c in lag_cols), F.lit(0.0)) / n
    var = sum(((F.col(c) - mean) * (F.col(c) - mean) for c in lag_cols), F.lit(0.0)) / n
    return [mean.alias("w_mean"), F.sqrt(var).alias("w_std"),
            (F.col(lag_cols[-1]) - F.col(lag_cols[0])).alias("w_trend")]
