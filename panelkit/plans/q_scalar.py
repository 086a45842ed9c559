"""Queries for row-level functions (E), forecasts without a fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import scalar as X
from panelkit.operators import aggregate as agg
from panelkit.operators import clean, forecast
from panelkit.plans import oracle as O
from panelkit.plans.q_panel import S, features
from panelkit.plans.registry import finish, query
from panelkit.sources.tables import panel_from_events

FLAG_SUM_SQL = " + ".join(K.FLAG_COLS) + " + qsofa"
SCORE_SQL = f"(({FLAG_SUM_SQL}) / 8e0)"


def _case(pairs: list[tuple[str, str]], default: str | None) -> str:
    body = " ".join(f"WHEN {c} THEN '{v}'" for c, v in pairs)
    return f"CASE {body} ELSE {'NULL' if default is None else repr(default)} END"


def _bin_sql(name: str) -> str:
    src, rules, default = K.EVENT_BINS[name]
    ops = {">": ">", "<": "<", ">=": ">=", "==": "="}
    return _case([(f"{src} {ops[op]} {t}e0", label) for op, t, label in rules], default) + f" AS {name}"


EVENTS_SQL = ", ".join(_bin_sql(n) for n in K.EVENT_COLS)


@query("event_bins", "E3",
       O.with_(O.FEATURE_CTES, f"SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, {EVENTS_SQL} FROM feat"))
def q_event_bins(spark, sf_dir):
    f = features(spark, sf_dir)
    return finish(f.select("patient_id", "iculos", *X.event_bins()))


@query("flags_on_raw", "E1 E2 T1",
       O.with_([O.PANEL], "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"CAST(CASE WHEN {src} {op} {t}e0 THEN 1 ELSE 0 END AS BIGINT) AS {name}"
                           for name, src, op, t in K.ALARM_FLAGS)
               + ", CAST((CASE WHEN resp > 22e0 THEN 1 ELSE 0 END) + (CASE WHEN map < 65e0 THEN 1 ELSE 0 END) AS BIGINT) AS qsofa"
               + " FROM panel"))
def q_flags_on_raw(spark, sf_dir):
    p = panel_from_events(spark, sf_dir)
    flagged = p.select("patient_id", "iculos", *X.alarm_flags())
    return finish(flagged.select("*", X.qsofa().alias("qsofa")))


TIER_SQL = _case([(f"{SCORE_SQL} >= 0.7e0", "HIGH RISK"), (f"{SCORE_SQL} >= 0.4e0", "MODERATE RISK")], "LOW RISK")
ACTION_SQL = ("CASE tier " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.API_ACTIONS.items())
              + f" ELSE '{K.DEFAULT_ACTION}' END")


@query("probability_tier", "E4 E6 G3 J17",
       O.with_(O.FEATURE_CTES + [f"t AS (SELECT patient_id, iculos, {SCORE_SQL} AS score, {TIER_SQL} AS tier FROM feat)"],
               f"SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(score, 6) AS score, tier, "
               f"{ACTION_SQL} AS action FROM t"))
def q_probability_tier(spark, sf_dir):
    f = features(spark, sf_dir)
    scored = f.select("patient_id", "iculos", agg.risk_score().alias("score"))
    scored = scored.withColumn("tier", X.probability_tier("score"))
    return finish(scored.withColumn("action", X.api_action("tier")))


ALERTS_SQL = ("concat_ws(', ', " + ", ".join(f"CASE WHEN {f} > 0 THEN '{t}' END" for f, t in K.ALERTS)
              + f", CASE WHEN qsofa >= 2 THEN '{K.QSOFA_ALERT}' END)")


@query("alert_list", "E7",
       O.with_(O.FEATURE_CTES, f"SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, {ALERTS_SQL} AS alerts, "
               "CAST(" + " + ".join(f"(CASE WHEN {f} > 0 THEN 1 ELSE 0 END)" for f, _ in K.ALERTS)
               + " + (CASE WHEN qsofa >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_alerts FROM feat"))
def q_alert_list(spark, sf_dir):
    f = features(spark, sf_dir)
    a = f.select("patient_id", "iculos", X.alert_list().alias("arr"))
    return finish(a.select("patient_id", "iculos", F.concat_ws(", ", "arr").alias("alerts"),
                           F.size("arr").alias("n_alerts")))


W_SQL = forecast.smoothing_weights()
LAGS = forecast.lag_names()
SMOOTH_SQL = " + ".join(f"lag{6 - i} * {w!r}" for i, w in enumerate(W_SQL))
WIN_CTE = ("win AS (SELECT * FROM (SELECT patient_id, iculos, "
           + ", ".join(f"lag(hr, {i}) OVER {O.W_ORD} AS lag{i}" for i in range(6, 0, -1))
           + f", hr AS y, row_number() OVER {O.W_ORD} AS rn FROM feat) t WHERE rn > 6)")


def _windows(spark, sf_dir):
    from panelkit.plans.q_panel import hr_windows
    return hr_windows(spark, sf_dir)


@query("exp_smoothing_forecast", "J11 D5",
       O.with_(O.FEATURE_CTES + [WIN_CTE],
               f"SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round({SMOOTH_SQL}, 6) AS pred, round(y, 6) AS y FROM win"))
def q_exp_smoothing(spark, sf_dir):
    w = _windows(spark, sf_dir)
    return finish(w.select("patient_id", "iculos", forecast.smoothing_forecast(LAGS).alias("pred"), "y"))


@query("forecast_trend_status", "E8 E9 J11",
       O.with_(O.FEATURE_CTES + [WIN_CTE, f"p AS (SELECT *, {SMOOTH_SQL} AS pred FROM win)"],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               "CASE WHEN pred > lag1 + 2e0 THEN 'rising' WHEN pred < lag1 - 2e0 THEN 'falling' ELSE 'stable' END AS trend, "
               "CASE WHEN pred > 120e0 THEN 'CRITICAL' WHEN pred > 100e0 THEN 'WARNING' ELSE 'NORMAL' END AS status FROM p"))
def q_forecast_trend_status(spark, sf_dir):
    w = _windows(spark, sf_dir).withColumn("pred", forecast.smoothing_forecast(LAGS))
    return finish(w.select("patient_id", "iculos", X.trend_label("pred", "lag1").alias("trend"),
                           X.hr_status("pred").alias("status")))


def _recursive_sql() -> str:
    cols = [f"lag{i}" for i in range(6, 0, -1)]
    steps = []
    exprs = {}
    for i in range(6):
        window = cols[-6:]
        e = " + ".join(f"({c}) * {w!r}" for c, w in zip(window, W_SQL))
        name = f"f{i + 1}"
        exprs[name] = e
        steps.append(name)
        cols = cols + [f"({e})"]
    return ", ".join(f"round({exprs[n]}, 6) AS {n}" for n in steps)


@query("recursive_forecast", "J14 J11",
       O.with_(O.FEATURE_CTES + [WIN_CTE],
               f"SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, {_recursive_sql()} FROM win"))
def q_recursive_forecast(spark, sf_dir):
    w = _windows(spark, sf_dir).select("patient_id", "iculos", *LAGS)
    out = forecast.recursive_forecast(w, LAGS)
    return finish(out.select("patient_id", "iculos", *[f"f{i}" for i in range(1, 7)]))


LIN_SQL = ", ".join(f"{O.bround_sql(f'lag1 + (lag1 - lag6) / 5e0 * {i}e0', 1)} AS x{i}" for i in range(1, 7))


@query("linear_extrapolation_alerts", "J15 E12 E13",
       O.with_(O.FEATURE_CTES + [WIN_CTE, f"x AS (SELECT patient_id, iculos, {LIN_SQL} FROM win)",
                                 "d AS (SELECT *, (CASE WHEN x1 > 100 THEN 1 ELSE 0 END) + (CASE WHEN x2 > 100 THEN 1 ELSE 0 END)"
                                 " + (CASE WHEN x3 > 100 THEN 1 ELSE 0 END) + (CASE WHEN x4 > 100 THEN 1 ELSE 0 END)"
                                 " + (CASE WHEN x5 > 100 THEN 1 ELSE 0 END) + (CASE WHEN x6 > 100 THEN 1 ELSE 0 END) AS danger FROM x)"],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"round(x{i}, 6) AS x{i}" for i in range(1, 7))
               + ", concat_ws(',', " + ", ".join(f"CASE WHEN x{i} > 100 THEN '1' ELSE '0' END" for i in range(1, 7))
               + ") AS step_alerts, CAST(danger AS BIGINT) AS danger_hours, danger > 0 AS alert, "
               "CASE WHEN danger > 0 THEN 'HR predicted >100bpm in ' || danger || ' of next 6 hours' "
               "ELSE 'No danger predicted' END AS alert_message FROM d"))
def q_linear_extrapolation(spark, sf_dir):
    w = _windows(spark, sf_dir)
    x = w.select("patient_id", "iculos", *forecast.linear_extrapolation(LAGS))
    steps = [f"x{i}" for i in range(1, 7)]
    return finish(x.select("patient_id", "iculos", *steps, *forecast.forecast_alerts(steps)))


@query("zone_from_scores", "E10 J1",
       O.with_(O.FEATURE_CTES + [
           "st AS (SELECT avg(hr) AS mh, stddev_pop(hr) AS sh, avg(resp) AS mr, stddev_pop(resp) AS sr FROM feat)",
           "z AS (SELECT patient_id, iculos, (hr - mh) / CASE WHEN sh = 0 THEN 1 ELSE sh END AS pc1, "
           "(resp - mr) / CASE WHEN sr = 0 THEN 1 ELSE sr END AS pc2 FROM feat, st)"],
           "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(pc1, 6) AS pc1, round(pc2, 6) AS pc2, "
           "CASE WHEN pc1 > 1.5e0 OR pc2 > 1.5e0 THEN 'RED ZONE' WHEN pc1 > 0.5e0 OR pc2 > 0.5e0 THEN 'YELLOW ZONE' "
           "ELSE 'GREEN ZONE' END AS zone FROM z"))
def q_zone_from_scores(spark, sf_dir):
    from panelkit.operators.models import standardize
    f = features(spark, sf_dir)
    z, _ = standardize(f, ["hr", "resp"], suffix="_z")
    z = z.select("patient_id", "iculos", F.col("hr_z").alias("pc1"), F.col("resp_z").alias("pc2"))
    return finish(z.withColumn("zone", X.zone("pc1", "pc2")))


PARTIAL_NULLS = ([c for c, _, _ in K.ROLLING_MEANS] + [c for c, _ in K.TRENDS]
                 + [c for c, _, _ in K.ROLLING_STDS] + K.FLAG_COLS + ["qsofa", "hours_in_icu"])


@query("record_completion", "B8",
       O.with_([O.PANEL, "c AS (SELECT patient_id, iculos, coalesce(hr, 85e0) AS hr, coalesce(o2sat, 96e0) AS o2sat, "
                "coalesce(temp, 37e0) AS temp, coalesce(sbp, 120e0) AS sbp, coalesce(map, 80e0) AS map, "
                "coalesce(resp, 16e0) AS resp, dbp, age, gender FROM panel)"],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(hr, 6) AS hr, round(o2sat, 6) AS o2sat, "
               "round(temp, 6) AS temp, round(sbp, 6) AS sbp, round(map, 6) AS map, round(coalesce(dbp, map - 10e0), 6) AS dbp, "
               "round(resp, 6) AS resp, round(age, 6) AS age, round(gender, 6) AS gender, "
               "round(hr, 6) AS hr_mean_3h, round(hr, 6) AS hr_mean_6h, round(sbp, 6) AS sbp_mean_3h, "
               "round(map, 6) AS map_mean_3h, round(resp, 6) AS resp_mean_3h, 0e0 AS hr_trend, 0e0 AS sbp_trend, "
               "0e0 AS temp_trend, 0e0 AS resp_trend, 2e0 AS hr_std_3h, 3e0 AS sbp_std_3h, "
               + ", ".join(f"CAST(CASE WHEN {src} {op} {t}e0 THEN 1 ELSE 0 END AS BIGINT) AS {name}"
                           for name, src, op, t in K.ALARM_FLAGS)
               + ", CAST((CASE WHEN resp > 22e0 THEN 1 ELSE 0 END) + (CASE WHEN map < 65e0 THEN 1 ELSE 0 END) AS BIGINT) AS qsofa"
               + ", 1e0 AS hours_in_icu FROM c"))
def q_record_completion(spark, sf_dir):
    p = panel_from_events(spark, sf_dir)
    partial = p.select("patient_id", "iculos", *[c for c in K.FEATURE_COLS[:9]],
                       *[F.lit(None).cast("double").alias(c) for c in PARTIAL_NULLS])
    return finish(clean.complete_record(partial))
