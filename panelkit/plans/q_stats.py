"""Queries for aggregates (F), lookups (G), ordering (H), splits (I),
metrics (M), quality gates (Q) and profiling (X)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import scalar as X
from panelkit.operators import aggregate as agg
from panelkit.operators import metrics as M
from panelkit.operators import clean, forecast, models, quality, split
from panelkit.plans import oracle as O
from panelkit.plans.q_panel import S, features
from panelkit.plans.registry import finish, query
from panelkit.sources.tables import panel_from_events

VITAL7 = ["hr", "o2sat", "temp", "sbp", "map", "dbp", "resp"]

# Fixed centres for segment assignment over (hr, o2sat, map): the published
# per-segment averages of the source pipeline's four clusters, ids 0..3.
FIXED_CENTRES = [[90.6, 85.2, 76.1], [103.1, 97.2, 84.1], [79.6, 97.4, 60.3], [78.3, 97.7, 82.0]]
CENTRE_COLS = ["hr", "o2sat", "map"]


def next_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelkit.plans.q_panel import next_hour_rows
    return next_hour_rows(spark, sf_dir)


def split_next_hour(spark: SparkSession, sf_dir: str):
    return split.ordered_split(next_hour(spark, sf_dir), S, K.TEST_FRACTION)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.assign_nearest(features(spark, sf_dir), FIXED_CENTRES, CENTRE_COLS, "cluster")


def _dist_sql(i: int) -> str:
    c = FIXED_CENTRES[i]
    return "sqrt(" + " + ".join(f"({col} - {v}e0) * ({col} - {v}e0)" for col, v in zip(CENTRE_COLS, c)) + ")"


ASSIGN_SQL = ("seg AS (SELECT *, CASE "
              + " ".join(
                  f"WHEN {' AND '.join(f'd{i} <= d{j}' if j > i else f'd{i} < d{j}' for j in range(4) if j != i)} THEN {i}"
                  for i in range(3))
              + " ELSE 3 END AS cluster FROM (SELECT *, "
              + ", ".join(f"{_dist_sql(i)} AS d{i}" for i in range(4)) + " FROM feat) t)")


@query("kmeans_assign_fixed", "J8 E13",
       O.with_(O.FEATURE_CTES + [ASSIGN_SQL],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"round(d{i}, 6) AS dist_{i}" for i in range(4))
               + ", CAST(cluster AS BIGINT) AS cluster FROM seg"))
def q_kmeans_assign_fixed(spark, sf_dir):
    s = segments(spark, sf_dir)
    return finish(s.select("patient_id", "iculos", *[f"dist_{i}" for i in range(4)], "cluster"))


SEG_PROFILE_SQL = ("SELECT CAST(cluster AS BIGINT) AS cluster, round(avg(hr), 6) AS avg_hr, round(avg(temp), 6) AS avg_temp, "
                   "round(avg(o2sat), 6) AS avg_o2sat, round(avg(map), 6) AS avg_map, round(avg(resp), 6) AS avg_resp, "
                   "round(avg(qsofa), 6) AS avg_qsofa, round(avg(flag_tachy), 6) AS tachy_rate, "
                   "round(avg(flag_low_bp), 6) AS low_bp_rate, round(avg(sepsislabel), 6) AS sepsis_rate, "
                   "CAST(count(hr) AS BIGINT) AS patient_count FROM seg GROUP BY cluster")


@query("segment_profile", "F2 E13", O.with_(O.FEATURE_CTES + [ASSIGN_SQL], SEG_PROFILE_SQL))
def q_segment_profile(spark, sf_dir):
    return finish(agg.segment_profile(segments(spark, sf_dir), "cluster"))


@query("segment_ranking_lookup", "H5 J9 G4",
       O.with_(O.FEATURE_CTES + [ASSIGN_SQL,
                                 "prof AS (SELECT cluster, avg(sepsislabel) AS sepsis_rate FROM seg GROUP BY cluster)",
                                 "lab AS (SELECT cluster, sepsis_rate, row_number() OVER (ORDER BY sepsis_rate, cluster) AS r FROM prof)"],
               "SELECT seg.patient_id, CAST(seg.iculos AS BIGINT) AS iculos, CAST(seg.cluster AS BIGINT) AS cluster, "
               "CASE lab.r " + " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(K.SEGMENT_LABELS))
               + " END AS risk_label FROM seg JOIN lab ON seg.cluster = lab.cluster"))
def q_segment_ranking_lookup(spark, sf_dir):
    seg = segments(spark, sf_dir)
    labels = models.segment_labels(agg.segment_profile(seg, "cluster"))
    out = seg.join(F.broadcast(labels.select("cluster", "risk_label")), on="cluster", how="inner")
    return finish(out.select("patient_id", "iculos", "cluster", "risk_label"))


@query("class_imbalance", "F3",
       O.with_(O.FEATURE_CTES, "SELECT CAST(sum(1 - sepsislabel) AS BIGINT) AS neg, CAST(sum(sepsislabel) AS BIGINT) AS pos, "
               "CAST(round_even(sum(1 - sepsislabel) / sum(sepsislabel), 0) AS BIGINT) AS ratio FROM feat"))
def q_class_imbalance(spark, sf_dir):
    return finish(agg.class_imbalance(features(spark, sf_dir)))


@query("label_distribution", "F4",
       O.with_(O.FEATURE_CTES, "SELECT CAST(sepsislabel AS BIGINT) AS sepsislabel, CAST(count(*) AS BIGINT) AS cnt "
               "FROM feat GROUP BY sepsislabel"))
def q_label_distribution(spark, sf_dir):
    return finish(agg.label_distribution(features(spark, sf_dir)))


def _events_sql() -> str:
    from panelkit.plans.q_scalar import EVENTS_SQL
    return EVENTS_SQL


@query("value_distribution", "F5 E3",
       O.with_(O.FEATURE_CTES + [f"ev AS (SELECT {_events_sql()} FROM feat)",
                                 "lng AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM ev"
                                                                 for c in K.EVENT_COLS[:5]) + ")",
                                 "cnt AS (SELECT \"column\", value, count(*) AS cnt FROM lng GROUP BY 1, 2)"],
               "SELECT \"column\", value, CAST(cnt AS BIGINT) AS cnt, "
               "round(cnt * 100e0 / sum(cnt) OVER (PARTITION BY \"column\"), 6) AS pct FROM cnt"))
def q_value_distribution(spark, sf_dir):
    ev = features(spark, sf_dir).select(*X.event_bins())
    return finish(agg.value_distribution(ev, K.EVENT_COLS[:5]))


@query("null_profile", "F6 X3 B7",
       O.with_([O.PANEL], " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM panel"
           for c in ["hr", "o2sat", "temp", "sbp", "map", "dbp", "resp", "lactate"])))
def q_null_profile(spark, sf_dir):
    p = panel_from_events(spark, sf_dir)
    return finish(agg.null_counts(p, ["hr", "o2sat", "temp", "sbp", "map", "dbp", "resp", "lactate"]))


@query("panel_counts", "F7",
       O.with_([O.PANEL, "pe AS (SELECT patient_id, count(*) AS n FROM panel GROUP BY patient_id)"],
               "SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS entities, "
               "CAST(min(n) AS BIGINT) AS min_rows_per_entity, CAST(max(n) AS BIGINT) AS max_rows_per_entity FROM pe"))
def q_panel_counts(spark, sf_dir):
    return finish(agg.panel_counts(panel_from_events(spark, sf_dir), S))


@query("rows_per_entity", "F7",
       O.with_([O.PANEL], "SELECT patient_id, CAST(count(*) AS BIGINT) AS rows FROM panel GROUP BY patient_id"))
def q_rows_per_entity(spark, sf_dir):
    return finish(agg.rows_per_entity(panel_from_events(spark, sf_dir), S))


def daily_sketches(spark, sf_dir):
    """Per day of ``events``: rows and a sketch of the users."""
    from panelkit.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events", ["ts", "user_id"])
    return agg.distinct_sketches(ev.select(F.to_date("ts").alias("day"), "user_id"), "user_id", ["day"])


@query("distinct_users_by_month", "F7")
def q_distinct_users_by_month(spark, sf_dir):
    """Estimated distinct users of each month and of all time, merged from the
    daily sketches (rows-only: SQL engines do not share sketch estimates)."""
    daily = daily_sketches(spark, sf_dir)
    monthly = agg.merged_distinct(daily.withColumn("month", F.date_format("day", "yyyy-MM")), ["month"])
    total = agg.merged_distinct(daily).select(F.lit("all").alias("month"), "rows", "distinct_values")
    return finish(monthly.unionByName(total))


@query("group_separation", "F8",
       O.with_(O.FEATURE_CTES, " UNION ALL ".join(
           f"SELECT '{c}' AS component, round(abs(avg(CASE WHEN sepsislabel = 1 THEN {c} END) - "
           f"avg(CASE WHEN sepsislabel = 0 THEN {c} END)), 6) AS separation FROM feat" for c in VITAL7)))
def q_group_separation(spark, sf_dir):
    return finish(agg.group_separation(features(spark, sf_dir), VITAL7))


@query("class_weights", "F9 I3",
       O.with_(O.FEATURE_CTES + ["c AS (SELECT sepsislabel, count(*) AS c FROM feat GROUP BY sepsislabel)",
                                 "w AS (SELECT sepsislabel, (SELECT sum(c) FROM c) / ((SELECT count(*) FROM c) * c) AS weight FROM c)"],
               "SELECT f.patient_id, CAST(f.iculos AS BIGINT) AS iculos, CAST(f.sepsislabel AS BIGINT) AS sepsislabel, "
               "round(w.weight, 6) AS weight FROM feat f JOIN w ON f.sepsislabel = w.sepsislabel"))
def q_class_weights(spark, sf_dir):
    f = features(spark, sf_dir).select("patient_id", "iculos", "sepsislabel")
    return finish(agg.class_weights(f))


@query("positive_weight", "F10 I3",
       O.with_(O.FEATURE_CTES + ["r AS (SELECT round_even(sum(1 - sepsislabel) / sum(sepsislabel), 0) AS ratio FROM feat)"],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, CAST(sepsislabel AS BIGINT) AS sepsislabel, "
               "round(CASE WHEN sepsislabel = 1 THEN (SELECT ratio FROM r) ELSE 1 END, 6) AS weight FROM feat"))
def q_positive_weight(spark, sf_dir):
    f = features(spark, sf_dir).select("patient_id", "iculos", "sepsislabel")
    return finish(agg.positive_weight(f))


@query("scaler_stats", "F11 J1",
       O.with_(O.FEATURE_CTES, " UNION ALL ".join(
           f"SELECT '{c}' AS feature, round({O.exact_mean_sql(c)}, 6) AS mean, "
           f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1e0 ELSE stddev_pop({c}) END, 6) AS std FROM feat"
           for c in K.FEATURE_COLS)))
def q_scaler_stats(spark, sf_dir):
    return finish(agg.scaler_stats(features(spark, sf_dir), K.FEATURE_COLS))


@query("correlation_matrix", "F12",
       O.with_(O.FEATURE_CTES, " UNION ALL ".join(
           f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM feat"
           for i, a in enumerate(VITAL7) for b in VITAL7[i + 1:])))
def q_correlation_matrix(spark, sf_dir):
    return finish(agg.correlation_pairs(features(spark, sf_dir), VITAL7))


@query("preview_first_rows", "X2 H1",
       O.with_(O.FEATURE_CTES, "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(hr, 6) AS hr, "
               "round(temp, 6) AS temp, round(o2sat, 6) AS o2sat, CAST(sepsislabel AS BIGINT) AS sepsislabel "
               "FROM feat ORDER BY patient_id, iculos LIMIT 10"))
def q_preview(spark, sf_dir):
    f = features(spark, sf_dir).select("patient_id", "iculos", "hr", "temp", "o2sat", "sepsislabel")
    return finish(f.orderBy("patient_id", "iculos").limit(10))


HASH_SQL = "md5(concat(patient_id, '-', CAST(iculos AS VARCHAR)))"


@query("hash_sample_first_n", "H2",
       O.with_(O.FEATURE_CTES, f"SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(hr, 6) AS hr FROM feat "
               f"ORDER BY {HASH_SQL} LIMIT 500"))
def q_hash_sample(spark, sf_dir):
    f = features(spark, sf_dir).select("patient_id", "iculos", "hr")
    return finish(split.hash_first(f, ["patient_id", "iculos"], 500))


@query("ordered_split", "I1 D4 B5",
       O.with_(O.SPLIT_CTES, "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               "rn <= n_all - CAST(ceil(n_all * 0.2) AS BIGINT) AS is_train FROM sp"))
def q_ordered_split(spark, sf_dir):
    nh = next_hour(spark, sf_dir).select("patient_id", "iculos")
    return finish(split.split_flag(nh, S, K.TEST_FRACTION))


@query("ordered_split_sizes", "I1 Q8",
       O.with_(O.SPLIT_CTES, "SELECT CAST((SELECT count(*) FROM train) AS BIGINT) AS train_rows, "
               "CAST((SELECT count(*) FROM test) AS BIGINT) AS test_rows, "
               "CAST((SELECT count(DISTINCT patient_id) FROM test) AS BIGINT) AS test_entities"))
def q_ordered_split_sizes(spark, sf_dir):
    nh = next_hour(spark, sf_dir).select("patient_id", "iculos")
    flagged = split.split_flag(nh, S, K.TEST_FRACTION)
    t = F.col("is_train")
    return finish(flagged.agg(
        F.sum(F.when(t, 1).otherwise(0)).alias("train_rows"),
        F.sum(F.when(~t, 1).otherwise(0)).alias("test_rows"),
        F.countDistinct(F.when(~t, F.col("patient_id"))).alias("test_entities")))


@query("balanced_sample", "I2 G2 H2",
       O.with_(O.FEATURE_CTES + [f"r AS (SELECT *, row_number() OVER (PARTITION BY sepsislabel ORDER BY {HASH_SQL}) AS rn FROM feat)"],
               "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, CAST(sepsislabel AS BIGINT) AS sepsislabel FROM r "
               "WHERE sepsislabel = 1 OR rn <= 3 * (SELECT sum(sepsislabel) FROM feat)"))
def q_balanced_sample(spark, sf_dir):
    f = features(spark, sf_dir).select("patient_id", "iculos", "sepsislabel")
    return finish(split.balanced_sample(f, ["patient_id", "iculos"], "sepsislabel", K.NEGATIVES_PER_POSITIVE))


# ---------------------------------------------------------------- metrics on deterministic scorers

CLF_MODELS = [("flag_score", O.RISK_SQL), ("qsofa_score", "(qsofa / 2e0)"),
              ("tachy_fever_score", "((flag_tachy + flag_fever) / 2e0)")]


def _clf_scores_spark(test: DataFrame) -> DataFrame:
    exprs = {"flag_score": agg.risk_score(),
             "qsofa_score": F.col("qsofa") / 2.0,
             "tachy_fever_score": (F.col("flag_tachy") + F.col("flag_fever")) / 2.0}
    base = test.select(F.col("sepsislabel").alias("label"),
                       *[e.alias(n) for n, e in exprs.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in exprs)
    long = base.selectExpr("label", f"stack({len(exprs)}, {pairs}) AS (model, score)")
    return long.withColumn("pred", F.when(F.col("score") >= 0.5, 1).otherwise(0))


CLF_SCORED_SQL = ("sc AS (" + " UNION ALL ".join(
    f"SELECT sepsislabel AS label, '{n}' AS model, {e} AS score FROM test" for n, e in CLF_MODELS)
    + "), pr AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc)")
CM_SQL = ("cm AS (SELECT model, sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp, "
          "sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp, "
          "sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn, "
          "sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn FROM pr GROUP BY model), "
          "cm2 AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END AS precision, "
          "CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END AS recall, "
          "CASE WHEN tp + fp + tn + fn = 0 THEN 0e0 ELSE (tp + tn) / (tp + fp + tn + fn) END AS accuracy FROM cm), "
          "cm3 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0e0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM cm2)")
AUC_SQL = ("g AS (SELECT model, score, sum(label) * 1e0 AS np, sum(1 - label) * 1e0 AS nn FROM sc GROUP BY model, score), "
           "gb AS (SELECT *, coalesce(sum(nn) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g), "
           "au AS (SELECT model, sum(np * below + np * nn / 2e0) / (sum(np) * sum(nn)) AS auroc FROM gb GROUP BY model)")


@query("confusion_metrics", "M1 G3",
       O.with_(O.SPLIT_CTES + [CLF_SCORED_SQL, CM_SQL],
               "SELECT model, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, "
               "CAST(fn AS BIGINT) AS fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, "
               "round(recall, 6) AS recall, round(f1, 6) AS f1 FROM cm3"))
def q_confusion_metrics(spark, sf_dir):
    _, test = split_next_hour(spark, sf_dir)
    return finish(M.confusion(_clf_scores_spark(test), "label", "pred", ["model"]))


@query("class_report", "M2",
       O.with_(O.SPLIT_CTES + [CLF_SCORED_SQL, CM_SQL.replace("FROM pr GROUP BY model", "FROM pr WHERE model = 'flag_score' GROUP BY model"),
                               "pc AS (SELECT CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END AS p1, "
                               "CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END AS r1, "
                               "CASE WHEN tn + fn = 0 THEN 0e0 ELSE tn / (tn + fn) END AS p0, "
                               "CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn / (tn + fp) END AS r0, tp + fn AS s1, tn + fp AS s0 FROM cm)",
                               "pf AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0e0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0, "
                               "CASE WHEN p1 + r1 = 0 THEN 0e0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1, s0 + s1 AS n FROM pc)"],
               "SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM pf "
               "UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM pf "
               "UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM pf "
               "UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6), "
               "round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM pf"))
def q_class_report(spark, sf_dir):
    _, test = split_next_hour(spark, sf_dir)
    sc = _clf_scores_spark(test).filter(F.col("model") == "flag_score")
    return finish(M.class_report(sc, "label", "pred"))


@query("auroc", "M3",
       O.with_(O.SPLIT_CTES + [CLF_SCORED_SQL, AUC_SQL], "SELECT model, round(auroc, 6) AS auroc FROM au"))
def q_auroc(spark, sf_dir):
    _, test = split_next_hour(spark, sf_dir)
    return finish(M.auroc(_clf_scores_spark(test), "score", "label", ["model"]))


@query("auroc_whole_panel", "M3",
       O.with_(O.FEATURE_CTES + [f"sc AS (SELECT sepsislabel AS label, 'hr' AS model, hr AS score FROM feat)", AUC_SQL],
               "SELECT model, round(auroc, 6) AS auroc FROM au"))
def q_auroc_whole_panel(spark, sf_dir):
    f = features(spark, sf_dir).select(F.col("sepsislabel").alias("label"), F.lit("hr").alias("model"),
                                       F.col("hr").alias("score"))
    return finish(M.auroc(f, "score", "label", ["model"]))


@query("classifier_leaderboard", "M4 M6 H6",
       O.with_(O.SPLIT_CTES + [CLF_SCORED_SQL, CM_SQL, AUC_SQL],
               "SELECT cm3.model, round(auroc, 6) AS auroc, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, "
               "round(recall, 6) AS sepsis_recall, round(0.6e0 * recall + 0.4e0 * auroc, 6) AS medical_score "
               "FROM cm3 JOIN au ON cm3.model = au.model"))
def q_classifier_leaderboard(spark, sf_dir):
    _, test = split_next_hour(spark, sf_dir)
    return finish(M.classifier_leaderboard(_clf_scores_spark(test)))


@query("best_classifier", "H6 M4",
       O.with_(O.SPLIT_CTES + [CLF_SCORED_SQL, CM_SQL, AUC_SQL,
                               "lb AS (SELECT cm3.model, 0.6e0 * recall + 0.4e0 * auroc AS medical_score, "
                               "CASE cm3.model " + " ".join(f"WHEN '{n}' THEN {i}" for i, (n, _) in enumerate(CLF_MODELS))
                               + " END AS ord FROM cm3 JOIN au ON cm3.model = au.model)"],
               "SELECT arg_min(model, [-medical_score, ord]) AS best_model, round(max(medical_score), 6) AS best_medical_score FROM lb"))
def q_best_classifier(spark, sf_dir):
    _, test = split_next_hour(spark, sf_dir)
    lb = M.classifier_leaderboard(_clf_scores_spark(test))
    order = X.lookup("model", {n: i for i, (n, _) in enumerate(CLF_MODELS)})
    return finish(M.best_by(lb.withColumn("ord", order), "medical_score", "model", True, "ord"))


TS_MODELS = [("Exp Smoothing", None), ("Last Value", "lag1"), ("Linear Trend Extrapolation", "lag1 + (lag1 - lag6) / 5e0")]


def _ts_sql() -> str:
    from panelkit.plans.q_scalar import SMOOTH_SQL
    exprs = [SMOOTH_SQL if e is None else e for _, e in TS_MODELS]
    return ("tsp AS (" + " UNION ALL ".join(f"SELECT '{n}' AS model, y, {e} AS pred FROM wtest"
                                           for (n, _), e in zip(TS_MODELS, exprs)) + ")")


def _ts_scored(spark, sf_dir) -> DataFrame:
    from panelkit.operators import forecast
    from panelkit.plans.q_panel import hr_windows
    w = hr_windows(spark, sf_dir)
    _, test = split.ordered_split(w, S, train_fraction=0.8)
    exprs = {"Exp Smoothing": forecast.smoothing_forecast(forecast.lag_names()),
             "Last Value": F.col("lag1"),
             "Linear Trend Extrapolation": F.col("lag1") + (F.col("lag1") - F.col("lag6")) / 5.0}
    parts = [test.select(F.lit(n).alias("model"), "y", e.alias("pred")) for n, e in exprs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("forecast_leaderboard", "M5 M6 J11 D5 I1",
       O.with_(O.WIN_CTES + [_ts_sql()],
               "SELECT model, CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse, "
               "round(avg(abs(y - pred)), 6) AS mae, round(1 - avg((y - pred) * (y - pred)) / var_pop(y), 6) AS r2 "
               "FROM tsp GROUP BY model"))
def q_forecast_leaderboard(spark, sf_dir):
    return finish(M.regression_metrics(_ts_scored(spark, sf_dir), "y", "pred", ["model"]))


@query("best_forecaster", "H6 M5",
       O.with_(O.WIN_CTES + [_ts_sql(), "lb AS (SELECT model, sqrt(avg((y - pred) * (y - pred))) AS rmse, CASE model "
                                         + " ".join(f"WHEN '{n}' THEN {i}" for i, (n, _) in enumerate(TS_MODELS))
                                         + " END AS ord FROM tsp GROUP BY model)"],
               "SELECT arg_min(model, [rmse, ord]) AS best_model, round(min(rmse), 6) AS best_rmse FROM lb"))
def q_best_forecaster(spark, sf_dir):
    lb = M.regression_metrics(_ts_scored(spark, sf_dir), "y", "pred", ["model"])
    order = X.lookup("model", {n: i for i, (n, _) in enumerate(TS_MODELS)})
    return finish(M.best_by(lb.withColumn("ord", order), "rmse", "model", False, "ord"))


# ---------------------------------------------------------------- quality gates

def _smooth_sql() -> str:
    from panelkit.plans.q_scalar import SMOOTH_SQL
    return SMOOTH_SQL


QUALITY_SQL = O.with_(
    O.FEATURE_CTES + [
        O.NH, O.WIN, ASSIGN_SQL,
        "ent AS (SELECT patient_id, count(*) AS n FROM feat GROUP BY patient_id)",
        "chk AS ("
        "SELECT 'panel_rows_above_floor' AS check_name, CAST((SELECT count(*) FROM feat) AS DOUBLE) AS observed, 700000e0 AS threshold, "
        "(SELECT count(*) FROM feat) > 700000 AS passed "
        "UNION ALL SELECT 'no_null_vitals', CAST(count(*) AS DOUBLE), 0e0, count(*) = 0 FROM feat WHERE hr IS NULL OR temp IS NULL OR o2sat IS NULL "
        "UNION ALL SELECT 'both_classes_present', CAST(count(DISTINCT sepsislabel) AS DOUBLE), 2e0, count(DISTINCT sepsislabel) = 2 FROM feat "
        f"UNION ALL SELECT 'score_in_unit_interval', CAST(sum(CASE WHEN {O.RISK_SQL} < 0 OR {O.RISK_SQL} > 1 THEN 1 ELSE 0 END) AS DOUBLE), 0e0, "
        f"sum(CASE WHEN {O.RISK_SQL} < 0 OR {O.RISK_SQL} > 1 THEN 1 ELSE 0 END) = 0 FROM feat "
        "UNION ALL SELECT 'grain_unique', CAST(count(*) - count(DISTINCT (patient_id, iculos)) AS DOUBLE), 0e0, "
        "count(*) = count(DISTINCT (patient_id, iculos)) FROM feat "
        "UNION ALL SELECT 'window_identity', CAST((SELECT count(*) FROM win) - (SELECT coalesce(sum(n - 6), 0) FROM ent WHERE n >= 7) AS DOUBLE), 0e0, "
        "(SELECT count(*) FROM win) = (SELECT coalesce(sum(n - 6), 0) FROM ent WHERE n >= 7) "
        "UNION ALL SELECT 'next_hour_identity', CAST((SELECT count(*) FROM nh) - ((SELECT count(*) FROM feat) - (SELECT count(*) FROM ent)) AS DOUBLE), 0e0, "
        "(SELECT count(*) FROM nh) = (SELECT count(*) FROM feat) - (SELECT count(*) FROM ent) "
        f"UNION ALL SELECT 'forecast_hr_in_range', CAST(sum(CASE WHEN p < 30e0 OR p > 250e0 THEN 1 ELSE 0 END) AS DOUBLE), 0e0, "
        f"coalesce(sum(CASE WHEN p < 30e0 OR p > 250e0 THEN 1 ELSE 0 END), 0) = 0 FROM (SELECT {_smooth_sql()} AS p FROM win) fp "
        "UNION ALL SELECT 'segment_in_range', CAST(sum(CASE WHEN cluster < 0 OR cluster > 3 THEN 1 ELSE 0 END) AS DOUBLE), 0e0, "
        "sum(CASE WHEN cluster < 0 OR cluster > 3 THEN 1 ELSE 0 END) = 0 FROM seg)"],
    "SELECT check_name, round(observed, 6) AS observed, round(threshold, 6) AS threshold, passed FROM chk "
    "UNION ALL SELECT 'all_passed', CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS DOUBLE), CAST(count(*) AS DOUBLE), bool_and(passed) FROM chk")


@query("covariance_matrix", "F12",
       O.with_(O.FEATURE_CTES, " UNION ALL ".join(
           f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop({a}, {b}), 6) AS cov FROM feat"
           for i, a in enumerate(VITAL7) for b in VITAL7[i:])))
def q_covariance_matrix(spark, sf_dir):
    return finish(agg.covariance_pairs(features(spark, sf_dir), VITAL7))


@query("quality_gates", "Q1 Q3 Q4 Q5 Q8 Q9 P7", QUALITY_SQL)
def q_quality_gates(spark, sf_dir):
    from panelkit.plans.q_panel import features_keyed
    f = features_keyed(spark, sf_dir)
    from panelkit.plans.q_panel import hr_windows, next_hour_rows
    nh = next_hour_rows(spark, sf_dir, f)
    win = hr_windows(spark, sf_dir, f)
    score = agg.risk_score()
    pred = forecast.smoothing_forecast(forecast.lag_names())
    clustered = models.assign_nearest(f, FIXED_CENTRES, CENTRE_COLS, "cluster")
    checks = [
        quality.row_checks(clustered, K.MIN_PANEL_ROWS, {
            "no_null_vitals": clean.any_null(["hr", "temp", "o2sat"]),
            "score_in_unit_interval": (score < 0.0) | (score > 1.0),
            "segment_in_range": (F.col("cluster") < 0) | (F.col("cluster") > K.KMEANS_K - 1),
        }, "panel_rows_above_floor"),
        quality.both_classes(f, "sepsislabel", "both_classes_present"),
        quality.grain_unique(f, ["patient_id", "iculos"], "grain_unique"),
        quality.panel_identities(f, win, nh, S, K.WINDOW_SIZE,
                                 (pred < K.HR_RANGE[0]) | (pred > K.HR_RANGE[1]), "forecast_hr_in_range"),
    ]
    return finish(quality.summary(checks))


@query("metric_floors", "Q7",
       O.with_(O.SPLIT_CTES + [CLF_SCORED_SQL, CM_SQL, AUC_SQL, O.WIN, O.WSPLIT, O.WTEST, _ts_sql(),
                               "m AS (SELECT 'best_medical_score' AS metric, max(0.6e0 * recall + 0.4e0 * auroc) AS value "
                               "FROM cm3 JOIN au ON cm3.model = au.model "
                               "UNION ALL SELECT 'best_rmse', min(r) FROM (SELECT sqrt(avg((y - pred) * (y - pred))) AS r FROM tsp GROUP BY model) t "
                               "UNION ALL SELECT 'train_rows', CAST(count(*) AS DOUBLE) FROM train)",
                               "t AS (SELECT 'best_medical_score' AS metric, 0.5e0 AS bound, 'min' AS kind "
                               "UNION ALL SELECT 'best_rmse', 15e0, 'max' UNION ALL SELECT 'train_rows', 500000e0, 'min')"],
               "SELECT m.metric, round(m.value, 6) AS value, round(t.bound, 6) AS bound, "
               "CASE WHEN t.kind = 'min' THEN m.value > t.bound ELSE m.value < t.bound END AS passed "
               "FROM m JOIN t ON m.metric = t.metric"))
def q_metric_floors(spark, sf_dir):
    train, test = split_next_hour(spark, sf_dir)
    lb = M.classifier_leaderboard(_clf_scores_spark(test))
    ts = M.regression_metrics(_ts_scored(spark, sf_dir), "y", "pred", ["model"])
    metrics_tbl = (lb.agg(F.max("medical_score").alias("value")).select(F.lit("best_medical_score").alias("metric"), "value")
                   .unionByName(ts.agg(F.min("rmse").alias("value")).select(F.lit("best_rmse").alias("metric"), "value"))
                   .unionByName(train.agg(F.count(F.lit(1)).cast("double").alias("value"))
                                .select(F.lit("train_rows").alias("metric"), "value")))
    floors = [("best_medical_score", K.FLOOR_MEDICAL_SCORE, "min"), ("best_rmse", K.CEIL_RMSE, "max"),
              ("train_rows", float(K.FLOOR_TRAIN_ROWS), "min")]
    return finish(quality.metric_floors(metrics_tbl, floors))
