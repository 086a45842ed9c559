"""Queries over the panel: scans, cleaning, windows, features (A, B, C, D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.operators import aggregate as agg
from panelkit.operators import clean, windows
from panelkit.operators.panel import ORDER_PANEL, VITAL_PANEL
from panelkit.plans import oracle as O
from panelkit.plans.registry import finish, query
from panelkit.sources.tables import panel_from_events, panel_from_orders

S = VITAL_PANEL


ORDER_KEYS = ("ts", "event_id")


def features_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 feature table that still carries its order keys (ts, event_id)."""
    from panelkit.operators import skew
    from panelkit.sources.tables import panel_rows_from_events
    return skew.feature_table(panel_rows_from_events(spark, sf_dir), "patient_id", list(ORDER_KEYS), "iculos",
                              known_no_hot=not panel_has_hot(spark, sf_dir), keep_order=True)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 feature table; hot entities (if any) go through the chunked plan."""
    return features_keyed(spark, sf_dir).drop(*ORDER_KEYS)


_HOT_MEMO: dict = {}


def panel_has_hot(spark: SparkSession, sf_dir: str) -> bool:
    """Hot-entity check on the raw scan (one column, one partial aggregate).

    The answer is remembered per application, path and file version
    (modification time and length), so a changed input is checked again."""
    from panelkit.operators import skew
    from panelkit.sources.tables import read_table, table_version
    version = table_version(spark, sf_dir, "events")
    key = (spark.sparkContext.applicationId if version is not None else None, sf_dir, version,
           skew.DEFAULT_CHUNK_ROWS)
    if version is None or key not in _HOT_MEMO:
        ev = read_table(spark, sf_dir, "events", ["user_id"]).withColumn(
            "patient_id", F.concat(F.lit("p"), F.lpad(F.col("user_id").cast("string"), 6, "0")))
        hot = skew.has_hot_entities(ev, "patient_id")
        if version is None:
            return hot
        _HOT_MEMO[key] = hot
    return _HOT_MEMO[key]


def hr_windows(spark: SparkSession, sf_dir: str, feats: DataFrame | None = None,
               column: str = "hr") -> DataFrame:
    """D5 over the feature table, chunked with halo rows if an entity is hot."""
    from panelkit.operators import skew
    f = feats if feats is not None else features_keyed(spark, sf_dir)
    keyed = all(c in f.columns for c in ORDER_KEYS)
    out = skew.per_entity(
        f, "patient_id", "iculos",
        lambda d, spec: windows.sliding_windows(d, spec, column, K.WINDOW_SIZE, ordinal="iculos",
                                                keep=("patient_id", "iculos")),
        back=K.WINDOW_SIZE, forward=0, hot=panel_has_hot(spark, sf_dir),
        order=ORDER_KEYS if keyed else None)
    return out.drop(*ORDER_KEYS)


def next_hour_rows(spark: SparkSession, sf_dir: str, feats: DataFrame | None = None) -> DataFrame:
    """D4 + B5 over the feature table, chunked with a forward halo if an entity is hot."""
    from panelkit.operators import skew
    f = feats if feats is not None else features_keyed(spark, sf_dir)
    keyed = all(c in f.columns for c in ORDER_KEYS)
    out = skew.per_entity(f, "patient_id", "iculos", lambda d, spec: windows.lead_target(d, spec),
                          back=0, forward=1, hot=panel_has_hot(spark, sf_dir),
                          order=ORDER_KEYS if keyed else None)
    return out.drop(*ORDER_KEYS)


def imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelkit.operators import skew
    from panelkit.sources.tables import PANEL_COLUMNS, panel_rows_from_events
    out, _ = skew.ordinal_and_impute(panel_rows_from_events(spark, sf_dir), "patient_id", ["ts", "event_id"],
                                     K.VITALS_LC, ["lactate"], "iculos",
                                     known_no_hot=not panel_has_hot(spark, sf_dir))
    return out.select(*PANEL_COLUMNS)


PANEL_COLS_SQL = ("patient_id, CAST(iculos AS BIGINT) AS iculos, "
                  + ", ".join(f"round({c}, 6) AS {c}" for c in O.VITALS + ["lactate", "age", "gender"])
                  + ", CAST(sepsislabel AS BIGINT) AS sepsislabel")


@query("panel_scan", "A8 B2 D7 D8", O.with_([O.PANEL], f"SELECT {PANEL_COLS_SQL} FROM panel"))
def q_panel_scan(spark, sf_dir):
    return finish(panel_from_events(spark, sf_dir))


@query("normalize_columns", "B1 B2",
       "SELECT 'p' || lpad(CAST(user_id AS varchar), 6, '0') AS patient_id, "
       "CAST(event_id AS BIGINT) AS event_id, round(value, 6) AS hr FROM events")
def q_normalize_columns(spark, sf_dir):
    from panelkit.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    raw = ev.select(F.concat(F.lit("p"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias(" Patient_ID "),
                    F.col("event_id").alias("Event_ID"), F.col("value").alias(" HR"))
    return finish(clean.normalize_columns(raw))


@query("positive_rows", "B3",
       O.with_([O.PANEL], f"SELECT {PANEL_COLS_SQL} FROM panel WHERE sepsislabel = 1"))
def q_positive_rows(spark, sf_dir):
    return finish(clean.where_equals(panel_from_events(spark, sf_dir), "sepsislabel", 1))


@query("min_history_window", "B4",
       "SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, "
       "round(o_totalprice, 6) AS o_totalprice FROM orders WHERE o_custkey IN "
       "(SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 7)")
def q_min_history_window(spark, sf_dir):
    df = panel_from_orders(spark, sf_dir)
    return finish(clean.min_history(df, ORDER_PANEL, 7, how="window")
                  .select("o_custkey", "o_orderkey", "o_totalprice"))


@query("min_history_semi", "B4 G1",
       "SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, "
       "round(o_totalprice, 6) AS o_totalprice FROM orders WHERE o_custkey IN "
       "(SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 7)")
def q_min_history_semi(spark, sf_dir):
    df = panel_from_orders(spark, sf_dir)
    return finish(clean.min_history(df, ORDER_PANEL, 7, how="semi")
                  .select("o_custkey", "o_orderkey", "o_totalprice"))


@query("raw_null_rows", "B7 F6",
       O.with_([O.PANEL], "SELECT CAST(count(*) AS BIGINT) AS null_rows FROM panel "
               "WHERE hr IS NULL OR temp IS NULL OR o2sat IS NULL"))
def q_raw_null_rows(spark, sf_dir):
    p = panel_from_events(spark, sf_dir)
    return finish(p.filter(clean.any_null(["hr", "temp", "o2sat"])).agg(F.count(F.lit(1)).alias("null_rows")))


@query("impute_ffill_bfill", "C1 C2",
       O.with_([O.PANEL, O.IMP], f"SELECT {PANEL_COLS_SQL} FROM imp"))
def q_impute(spark, sf_dir):
    return finish(imputed(spark, sf_dir))


@query("impute_forward_only", "C2",
       O.with_([O.PANEL], "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"round(last_value({c} IGNORE NULLS) OVER {O.W_RUN}, 6) AS {c}"
                           for c in O.VITALS + ["lactate"])
               + " FROM panel"))
def q_impute_forward_only(spark, sf_dir):
    from panelkit.operators import skew
    from panelkit.sources.tables import panel_rows_from_events
    cols = K.VITALS_LC + ["lactate"]
    out, _ = skew.ordinal_and_impute(panel_rows_from_events(spark, sf_dir), "patient_id", ["ts", "event_id"],
                                     [], cols, "iculos", known_no_hot=not panel_has_hot(spark, sf_dir))
    return finish(out.select("patient_id", "iculos", *cols))


@query("impute_median_entity", "C3",
       O.with_([O.PANEL], "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"round(coalesce({c}, median({c}) OVER (PARTITION BY patient_id)), 6) AS {c}"
                           for c in ["hr", "temp", "lactate"])
               + " FROM panel"))
def q_impute_median_entity(spark, sf_dir):
    p = panel_from_events(spark, sf_dir)
    cols = ["hr", "temp", "lactate"]
    return finish(clean.fill_median(p, cols, S).select("patient_id", "iculos", *cols))


@query("impute_median_global", "C3",
       O.with_([O.PANEL], "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"round(coalesce({c}, (SELECT median({c}) FROM panel)), 6) AS {c}"
                           for c in ["hr", "temp", "lactate"])
               + " FROM panel"))
def q_impute_median_global(spark, sf_dir):
    p = panel_from_events(spark, sf_dir)
    cols = ["hr", "temp", "lactate"]
    return finish(clean.fill_median(p, cols, None).select("patient_id", "iculos", *cols))


@query("feature_table", "P2 C1 C2 C4 C5 D1 D2 D3 D7 D8 E1 E2 A9",
       O.with_(O.FEATURE_CTES, f"SELECT {O.feature_select()} FROM feat"))
def q_feature_table(spark, sf_dir):
    return finish(features(spark, sf_dir))


@query("feature_table_chunked", "P2 C1 C2 D1 D2 D3 D7 E1 E2 skew",
       O.with_(O.FEATURE_CTES, f"SELECT {O.feature_select()} FROM feat"))
def q_feature_table_chunked(spark, sf_dir):
    """The feature table through the skew-safe plan, with chunks of 16 rows so
    every entity of the test data is cut into several chunks."""
    from panelkit.operators import skew
    from panelkit.sources.tables import panel_rows_from_events
    raw = panel_rows_from_events(spark, sf_dir)
    return finish(skew.feature_table(raw, "patient_id", ["ts", "event_id"], "iculos", chunk_rows=16))


@query("rolling_hr", "D1 D2 D3",
       O.with_([O.PANEL, O.IMP],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               f"round(avg(hr) OVER {O.w_trail(3)}, 6) AS hr_mean_3h, "
               f"round(avg(hr) OVER {O.w_trail(6)}, 6) AS hr_mean_6h, "
               f"round(coalesce(stddev_samp(hr) OVER {O.w_trail(3)}, 0e0), 6) AS hr_std_3h, "
               f"round(hr - lag(hr) OVER {O.W_ORD}, 6) AS hr_trend FROM imp"))
def q_rolling_hr(spark, sf_dir):
    from panelkit.operators import skew

    def frames(d, spec):
        return d.select("*", windows.rolling_mean("hr", 3, spec).alias("hr_mean_3h"),
                        windows.rolling_mean("hr", 6, spec).alias("hr_mean_6h"),
                        windows.rolling_std("hr", 3, spec).alias("hr_std_3h"),
                        windows.diff("hr", spec).alias("hr_trend"))
    out = skew.per_entity(imputed(spark, sf_dir), "patient_id", "iculos", frames, back=5, forward=0,
                          hot=panel_has_hot(spark, sf_dir))
    return finish(out.select("patient_id", "iculos", "hr_mean_3h", "hr_mean_6h", "hr_std_3h", "hr_trend"))


@query("rolling_raw_gaps", "D1 D2 D3 T7",
       O.with_([O.PANEL],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               f"round(avg(map) OVER {O.w_trail(3)}, 6) AS map_mean_3h, "
               f"round(coalesce(stddev_samp(map) OVER {O.w_trail(3)}, 0e0), 6) AS map_std_3h, "
               f"round(map - lag(map) OVER {O.W_ORD}, 6) AS map_trend FROM panel"))
def q_rolling_raw_gaps(spark, sf_dir):
    from panelkit.operators import skew

    def frames(d, spec):
        return d.select("*", windows.rolling_mean("map", 3, spec).alias("map_mean_3h"),
                        windows.rolling_std("map", 3, spec).alias("map_std_3h"),
                        windows.diff("map", spec).alias("map_trend"))
    out = skew.per_entity(panel_from_events(spark, sf_dir), "patient_id", "iculos", frames, back=2, forward=0,
                          hot=panel_has_hot(spark, sf_dir))
    return finish(out.select("patient_id", "iculos", "map_mean_3h", "map_std_3h", "map_trend"))


@query("next_hour_target", "D4 B5",
       O.with_(O.FEATURE_CTES,
               "SELECT * FROM (SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(hr, 6) AS hr, "
               f"round(lead(hr) OVER {O.W_ORD}, 6) AS hr_next_hour FROM feat) t "
               "WHERE hr_next_hour IS NOT NULL"))
def q_next_hour_target(spark, sf_dir):
    return finish(next_hour_rows(spark, sf_dir).select("patient_id", "iculos", "hr", "hr_next_hour"))


LAG_SQL = ", ".join(f"lag(hr, {i}) OVER {O.W_ORD} AS lag{i}" for i in range(6, 0, -1))


@query("sliding_windows", "D5 B4",
       O.with_(O.FEATURE_CTES + [
           f"win AS (SELECT patient_id, iculos, {LAG_SQL}, hr AS y, "
           f"row_number() OVER {O.W_ORD} AS rn FROM feat)"],
           "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
           + ", ".join(f"round(lag{i}, 6) AS lag{i}" for i in range(6, 0, -1))
           + ", round(y, 6) AS y FROM win WHERE rn > 6"))
def q_sliding_windows(spark, sf_dir):
    return finish(hr_windows(spark, sf_dir))


def _numbered_orders(spark, sf_dir):
    """Orders panel with a dense per-customer ordinal ``seq`` (hot customers chunked)."""
    from panelkit.operators import skew
    df = panel_from_orders(spark, sf_dir)
    out, chunked = skew.ordinal_and_impute(df, "o_custkey", ["o_orderdate", "o_orderkey"], [], [], "seq")
    return out, chunked


@query("sliding_windows_orders", "D5 B4 D8",
       "SELECT o_custkey, o_orderkey, lag6, lag5, lag4, lag3, lag2, lag1, y FROM (SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, "
       + ", ".join(f"round(lag(o_totalprice, {i}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 6) AS lag{i}"
                   for i in range(6, 0, -1))
       + ", round(o_totalprice, 6) AS y, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn "
       "FROM orders) t WHERE rn > 6")
def q_sliding_windows_orders(spark, sf_dir):
    from panelkit.operators import skew
    df, hot = _numbered_orders(spark, sf_dir)
    out = skew.per_entity(
        df, "o_custkey", "seq",
        lambda d, spec: windows.sliding_windows(d, spec, "o_totalprice", K.WINDOW_SIZE, ordinal="seq",
                                                keep=("o_custkey", "o_orderkey")),
        back=K.WINDOW_SIZE, forward=0, hot=hot)
    return finish(out.drop("seq", "o_orderdate"))


@query("window_summary", "D5 D6",
       O.with_(O.FEATURE_CTES + [
           f"win AS (SELECT patient_id, iculos, {LAG_SQL}, row_number() OVER {O.W_ORD} AS rn FROM feat)",
           "s AS (SELECT *, (lag6+lag5+lag4+lag3+lag2+lag1)/6e0 AS m FROM win WHERE rn > 6)"],
           "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(m, 6) AS w_mean, "
           "round(sqrt(((lag6-m)*(lag6-m)+(lag5-m)*(lag5-m)+(lag4-m)*(lag4-m)+(lag3-m)*(lag3-m)"
           "+(lag2-m)*(lag2-m)+(lag1-m)*(lag1-m))/6e0), 6) AS w_std, round(lag1 - lag6, 6) AS w_trend FROM s"))
def q_window_summary(spark, sf_dir):
    win = hr_windows(spark, sf_dir)
    lags = [f"lag{i}" for i in range(6, 0, -1)]
    return finish(win.select("patient_id", "iculos", *windows.window_summary(lags)))


@query("ordinal_orders", "D7 D8",
       "SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, "
       "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS seq "
       "FROM orders")
def q_ordinal_orders(spark, sf_dir):
    df, _ = _numbered_orders(spark, sf_dir)
    return finish(df.select("o_custkey", "o_orderkey", "seq"))


@query("entity_profile", "F1 P5",
       O.with_(O.FEATURE_CTES,
               "SELECT patient_id, round(avg(hr), 6) AS avg_hr, round(avg(temp), 6) AS avg_temp, "
               "round(avg(o2sat), 6) AS avg_o2sat, round(avg(sbp), 6) AS avg_sbp, round(avg(map), 6) AS avg_map, "
               "round(avg(resp), 6) AS avg_resp, CAST(max(qsofa) AS BIGINT) AS max_qsofa, "
               "CAST(max(flag_tachy) AS BIGINT) AS had_tachy, CAST(max(flag_fever) AS BIGINT) AS had_fever, "
               "CAST(max(flag_low_bp) AS BIGINT) AS had_low_bp, CAST(max(flag_hypoxia) AS BIGINT) AS had_hypoxia, "
               "CAST(max(sepsislabel) AS BIGINT) AS had_sepsis, CAST(max(iculos) AS BIGINT) AS total_icu_hours "
               "FROM feat GROUP BY patient_id"))
def q_entity_profile(spark, sf_dir):
    return finish(agg.entity_profile(features(spark, sf_dir), S))


@query("risk_tier_summary", "P2 F1 E4 E13",
       O.with_(O.FEATURE_CTES + [
           "pe AS (SELECT patient_id, max((flag_tachy + flag_hypoxia + flag_fever + flag_hypotemp + flag_low_bp "
           "+ flag_tachypnea + qsofa) / 8e0) AS peak_score, avg(hr) AS avg_hr, avg(temp) AS avg_temp, "
           "avg(o2sat) AS avg_o2sat, max(sepsislabel) AS had_sepsis FROM feat GROUP BY patient_id)",
           "pt AS (SELECT *, CASE WHEN peak_score >= 0.7e0 THEN 'HIGH RISK' WHEN peak_score >= 0.4e0 "
           "THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS tier FROM pe)"],
           "SELECT tier, CAST(count(*) AS BIGINT) AS entities, CAST(sum(had_sepsis) AS BIGINT) AS with_sepsis, "
           "round(avg(avg_hr), 6) AS avg_hr, round(avg(avg_temp), 6) AS avg_temp, round(avg(avg_o2sat), 6) AS avg_o2sat "
           "FROM pt GROUP BY tier"))
def q_risk_tier_summary(spark, sf_dir):
    return finish(risk_tier_summary(features(spark, sf_dir)))


def risk_tier_summary(feats: DataFrame) -> DataFrame:
    """Flagship: entities per peak-risk tier, with their mean vitals.

    Two hash aggregates (per entity, then per tier), both with partial
    aggregation; the tier table has at most three rows."""
    from panelkit.functions import scalar as X
    per = feats.groupBy(S.entity).agg(
        F.max(agg.risk_score()).alias("peak_score"), F.avg("hr").alias("avg_hr"),
        F.avg("temp").alias("avg_temp"), F.avg("o2sat").alias("avg_o2sat"),
        F.max("sepsislabel").alias("had_sepsis"))
    per = per.withColumn("tier", X.probability_tier("peak_score"))
    return per.groupBy("tier").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("had_sepsis").alias("with_sepsis"),
        F.avg("avg_hr").alias("avg_hr"), F.avg("avg_temp").alias("avg_temp"),
        F.avg("avg_o2sat").alias("avg_o2sat"))
