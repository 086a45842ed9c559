"""Skew-safe per-entity windows: no entity's rows ever go to one task whole.

A plain ``Window.partitionBy(entity)`` sends every row of an entity to one
task; an entity holding a third of all rows would then be a third of the
job in one task. This module computes the same results with bounded
partitions:

1. one partially aggregated pass counts rows and the time span per entity;
   entities above ``chunk_rows`` are *hot* (there are at most
   total/chunk_rows of them, so the list is bounded and broadcast);
2. rows of a hot entity are cut into equal-width time chunks; a per-chunk
   table (one row per chunk: row count, last and first non-null value per
   column) is folded into carries -- ordinal offset, forward-fill value
   from earlier chunks, the entity's first non-null -- and broadcast back;
3. ordinal and imputation run as windows over (entity, time chunk);
4. frames of a few rows (rolling, lag, lead) run over (entity, ordinal
   chunk) where each chunk also receives the last ``back`` rows of the chunk
   before it and the first ``forward`` rows of the next as halo rows, which
   are dropped after the window.

Results equal the plain plan row for row (tests compare both). Without hot
entities the plain one-exchange plan is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from panelkit import constants as K
from panelkit.config import BROADCAST_ROW_LIMIT
from panelkit.operators import clean, windows
from panelkit.operators.panel import PanelSpec

DEFAULT_CHUNK_ROWS = 2_000_000
# time chunks are equal-width, so a hot entity is cut OVERSPLIT times finer
# than its row count needs; bursts in time then still spread over chunks
OVERSPLIT = 4


def _numeric_time(df: DataFrame, col: str) -> Column:
    t = df.schema[col].dataType
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(t, DateType):
        return F.unix_date(F.col(col)).cast("double")
    return F.col(col).cast("double")


def hot_entities(df: DataFrame, entity: str, time_col: str, chunk_rows: int) -> DataFrame:
    """Entities with more than ``chunk_rows`` rows, with their time span and
    chunk count: (entity, _m, _t0, _width). Bounded by total/chunk_rows rows."""
    stats = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"),
                                   F.min(_numeric_time(df, time_col)).alias("_t0"),
                                   F.max(_numeric_time(df, time_col)).alias("_t1"))
    hot = stats.filter(F.col("_n") > chunk_rows)
    m = (F.ceil(F.col("_n") / F.lit(float(chunk_rows))) * OVERSPLIT).cast("int")
    return hot.select(entity, m.alias("_m"), "_t0",
                      ((F.col("_t1") - F.col("_t0")) / m).alias("_width"))


def _chunk_expr(tnum: Column) -> Column:
    raw = F.floor((tnum - F.col("_t0")) / F.col("_width")).cast("int")
    return (F.when(F.col("_m").isNull() | (F.col("_width") <= 0), F.lit(0))
            .otherwise(F.least(F.col("_m") - 1, F.greatest(F.lit(0), raw))))


def ordinal_and_impute(df: DataFrame, entity: str, order: list[str], both_ways: list[str],
                       forward_only: list[str], ordinal: str = "iculos",
                       chunk_rows: int = DEFAULT_CHUNK_ROWS,
                       known_no_hot: bool = False) -> tuple[DataFrame, bool]:
    """Ordinal (row_number by ``order``) plus C1/C2 imputation per entity.

    Returns (frame, chunked). ``order[0]`` is the time column used to cut
    hot entities; ``order`` must be unique within an entity. A caller that
    already knows no entity exceeds ``chunk_rows`` skips the detection job.
    """
    cols = both_ways + forward_only
    hot = hot_entities(df, entity, order[0], chunk_rows)
    hot_rows = [] if known_no_hot else hot.limit(BROADCAST_ROW_LIMIT + 1).collect()
    if len(hot_rows) > BROADCAST_ROW_LIMIT:
        raise ValueError("too many hot entities to broadcast; raise chunk_rows")
    if not hot_rows:
        # ordinal and fills share one Window spec (entity, order): one sort
        spec = PanelSpec(entity, tuple(order))
        out = df.withColumn(ordinal, windows.ordinal(spec).cast("int"))
        out = clean.impute(out, spec, both_ways, forward_only)
        return out, False
    spark = df.sparkSession
    hot_df = spark.createDataFrame(hot_rows, hot.schema)
    rows = df.join(F.broadcast(hot_df), on=entity, how="left")
    rows = rows.withColumn("_c1", _chunk_expr(_numeric_time(df, order[0]))).drop("_m", "_t0", "_width")

    # per-chunk table for hot entities: count, last and first non-null per column
    okey = F.struct(*[F.col(o) for o in order])
    per_chunk = (rows.join(F.broadcast(hot_df.select(entity)), on=entity, how="left_semi")
                 .groupBy(entity, "_c1").agg(
                     F.count(F.lit(1)).alias("_cnt"),
                     *[F.max(F.when(F.col(c).isNotNull(), F.struct(okey.alias("k"), F.col(c).alias("v"))))["v"]
                       .alias(f"_last_{c}") for c in cols],
                     *[F.min(F.when(F.col(c).isNotNull(), F.struct(okey.alias("k"), F.col(c).alias("v"))))["v"]
                       .alias(f"_first_{c}") for c in both_ways]))
    wc = Window.partitionBy(entity).orderBy("_c1")
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    whole = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carries = per_chunk.select(
        entity, "_c1",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols],
        *[F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_efirst_{c}") for c in both_ways])
    rows = rows.join(F.broadcast(carries), on=[entity, "_c1"], how="left")

    rows = rows.withColumn("_pk1", F.struct(F.col(entity), F.col("_c1")))
    w = Window.partitionBy("_pk1").orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    allw = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    repl = {c: F.coalesce(F.last(c, True).over(run), F.col(f"_carry_{c}"), F.col(f"_efirst_{c}"),
                          F.first(c, True).over(allw)).alias(c) for c in both_ways}
    repl.update({c: F.coalesce(F.last(c, True).over(run), F.col(f"_carry_{c}")).alias(c) for c in forward_only})
    ordcol = (F.coalesce(F.col("_off"), F.lit(0)) + F.row_number().over(w)).cast("int").alias(ordinal)
    keep = [c for c in df.columns]
    out = rows.select(*[repl.get(c, F.col(c)) for c in keep], ordcol)
    return out, True


def with_halo(df: DataFrame, entity: str, ordinal: str, chunk_rows: int,
              back: int, forward: int = 0) -> tuple[DataFrame, PanelSpec]:
    """Assign (entity, ordinal chunk) partitions with halo rows.

    Each row belongs to chunk floor((ordinal-1)/chunk_rows); the last
    ``back`` rows of a chunk are copied into the next chunk and the first
    ``forward`` rows into the previous one, flagged ``_halo``. Windows over
    the returned spec are exact for non-halo rows when their frame reaches
    at most ``back`` rows behind and ``forward`` rows ahead.
    """
    if back >= chunk_rows or forward >= chunk_rows:
        raise ValueError("halo must be smaller than a chunk")
    k = F.floor((F.col(ordinal) - 1) / F.lit(chunk_rows)).cast("int")
    pos = (F.col(ordinal) - 1) % F.lit(chunk_rows)
    targets = F.array_compact(F.array(
        k,
        F.when(pos >= chunk_rows - back, k + 1),
        F.when((pos < forward) & (k > 0), k - 1)))
    out = (df.withColumn("_home", k).withColumn("_c2", F.explode(targets))
           .withColumn("_halo", F.col("_c2") != F.col("_home"))
           .withColumn("_pk2", F.struct(F.col(entity), F.col("_c2")))
           .drop("_home"))
    return out, PanelSpec("_pk2", (ordinal,))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_halo", "_c2", "_pk2")


def feature_table(raw: DataFrame, entity: str, order: list[str], ordinal: str = "iculos",
                  chunk_rows: int = DEFAULT_CHUNK_ROWS, fill_value: float | None = 0.0,
                  known_no_hot: bool = False, keep_order: bool = False) -> DataFrame:
    """Skew-safe P2: ordinal + imputation + engineered features + fill.

    ``raw`` is the panel before the ordinal (e.g. event rows with ts and id).
    Equal to ``windows.feature_table`` on the plain panel.
    """
    vitals = [c for c in K.VITALS_LC if c in raw.columns]
    labs = [c for c in K.LABS_LC if c in raw.columns]
    imputed, chunked = ordinal_and_impute(clean.nan_to_null(raw), entity, order, vitals, labs,
                                          ordinal, chunk_rows, known_no_hot)
    if not chunked:
        # frames ordered by the original keys (same row order as the ordinal),
        # so the whole chain reuses the first sort
        feats = windows.add_features(imputed, PanelSpec(entity, tuple(order)), hours_col=ordinal)
    else:
        reach = max(n for _, _, n in K.ROLLING_MEANS + K.ROLLING_STDS) - 1
        halo, spec = with_halo(imputed, entity, ordinal, chunk_rows, back=max(reach, 1))
        feats = drop_halo(windows.add_features(halo, spec)).drop("_pk2")
    if not keep_order:
        # keep_order leaves the order keys in, so later per-entity windows
        # ordered by them reuse this plan's sort
        feats = feats.drop(*order)
    if fill_value is None:
        return feats
    # fill every numeric column except the order keys: rewriting a key column
    # would hide the sort order from later windows
    fill_cols = [f.name for f in feats.schema.fields
                 if f.name not in order and isinstance(f.dataType, NumericType)]
    return clean.fill_constant(feats, fill_value, fill_cols)


def has_hot_entities(df: DataFrame, entity: str, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> bool:
    """Whether any entity has more than ``chunk_rows`` rows (one partial aggregate;
    run it on the cheapest frame that has the entity, e.g. the raw scan)."""
    return bool(df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > chunk_rows).limit(1).collect())


def per_entity(df: DataFrame, entity: str, ordinal: str, fn, back: int, forward: int,
               hot: bool, chunk_rows: int = DEFAULT_CHUNK_ROWS,
               order: tuple[str, ...] | None = None) -> DataFrame:
    """Apply ``fn(frame, spec)`` -- window operators whose frames reach at most
    ``back`` rows behind and ``forward`` ahead -- per entity.

    Without hot entities this is ``fn(df, PanelSpec(entity, (ordinal,)))``;
    with them, ``fn`` runs over (entity, ordinal chunk) partitions with halo
    rows, which are dropped from its result. ``ordinal`` must be the dense
    1-based position within the entity. Without hot entities, ``order``
    (columns in the same row order as the ordinal, e.g. the keys the ordinal
    was numbered by) lets the windows reuse the sort that produced ``df``.
    """
    if not hot:
        return fn(df, PanelSpec(entity, tuple(order) if order else (ordinal,)))
    halo, spec = with_halo(df, entity, ordinal, chunk_rows, back, forward)
    return drop_halo(fn(halo, spec))
