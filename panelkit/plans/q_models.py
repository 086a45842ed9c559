"""Look-alike (J12, J13, E5, E11, E14) and fitted-model queries.

Fitted models have no SQL oracle (their values depend on the optimiser);
their queries are rows-only in the driver and have invariant tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.config import cut_lineage
from panelkit.operators import aggregate as agg
from panelkit.operators import forecast, knn_join, metrics as M, models, neighbors, split, windows
from panelkit.plans import oracle as O
from panelkit.plans.q_panel import S, features, hr_windows
from panelkit.plans.q_stats import next_hour
from panelkit.plans.registry import finish, query

# look-alike probes: the high-risk profile used by the batch job and the
# request-model defaults, in PROFILE_FEATURES order (fixed values)
LOOKALIKE_PROBES = [
    ("probe_high_risk", [105.0, 38.5, 91.0, 88.0, 62.0, 24.0, 2.0, 1.0, 1.0, 1.0, 1.0, 8.0]),
    ("probe_defaults", [85.0, 37.0, 96.0, 120.0, 80.0, 16.0, 0.0, 0.0, 0.0, 0.0, 0.0, 24.0]),
]
PF = K.PROFILE_FEATURES


def probes(spark) -> DataFrame:
    rows = [(name, *vals) for name, vals in LOOKALIKE_PROBES]
    schema = "query_id string, " + ", ".join(f"{c} double" for c in PF)
    return spark.createDataFrame(rows, schema)


def profiles(spark, sf_dir) -> DataFrame:
    p = agg.entity_profile(features(spark, sf_dir), S)
    return p.select("patient_id", *[F.col(c).cast("double").alias(c) for c in PF], "had_sepsis")


def lookalikes(spark, sf_dir) -> DataFrame:
    return neighbors.knn(profiles(spark, sf_dir), probes(spark), PF, K.KNN_K)


PROFILE_SQL = ("prof AS (SELECT patient_id, avg(hr) AS avg_hr, avg(temp) AS avg_temp, avg(o2sat) AS avg_o2sat, "
               "avg(sbp) AS avg_sbp, avg(map) AS avg_map, avg(resp) AS avg_resp, CAST(max(qsofa) AS DOUBLE) AS max_qsofa, "
               "CAST(max(flag_tachy) AS DOUBLE) AS had_tachy, CAST(max(flag_fever) AS DOUBLE) AS had_fever, "
               "CAST(max(flag_low_bp) AS DOUBLE) AS had_low_bp, CAST(max(flag_hypoxia) AS DOUBLE) AS had_hypoxia, "
               "CAST(max(iculos) AS DOUBLE) AS total_icu_hours, max(sepsislabel) AS had_sepsis FROM feat GROUP BY patient_id)")
STATS_SQL = ("st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s_{c}" for c in PF)
    + " FROM prof)")
PROBES_SQL = ("q AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS query_id, " + ", ".join(f"{v!r}e0 AS {c}" if "e" not in repr(v) else f"{v!r} AS {c}"
                                               for c, v in zip(PF, vals))
    for n, vals in LOOKALIKE_PROBES) + ")")
DIST_SQL = ("d AS (SELECT q.query_id, p.patient_id, p.had_sepsis, p.total_icu_hours, "
            + " + ".join(f"(((p.{c} - st.m_{c}) / st.s_{c}) - ((q.{c} - st.m_{c}) / st.s_{c})) * "
                         f"(((p.{c} - st.m_{c}) / st.s_{c}) - ((q.{c} - st.m_{c}) / st.s_{c}))" for c in PF)
            + " AS d2 FROM q, prof p, st)")
RANK_SQL = ("nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d2, patient_id) AS rank "
            "FROM d) t WHERE rank <= 10)")
KNN_CTES = O.FEATURE_CTES + [PROFILE_SQL, STATS_SQL, PROBES_SQL, DIST_SQL, RANK_SQL]


@query("knn_lookalikes", "J12 G5 E11 E14",
       O.with_(KNN_CTES, "SELECT query_id, CAST(rank AS BIGINT) AS rank, patient_id, round(sqrt(d2), 6) AS distance, "
               + O.bround_sql("1e0 / (1e0 + sqrt(d2)) * 100e0", 1) + " AS similarity, "
               "CASE WHEN had_sepsis = 1 THEN 'HAD SEPSIS' ELSE 'No Sepsis' END AS outcome FROM nb"))
def q_knn_lookalikes(spark, sf_dir):
    nb = neighbors.describe_neighbours(lookalikes(spark, sf_dir))
    return finish(nb.select("query_id", "rank", "patient_id", "distance", "similarity", "outcome"))


def _job_case(idx: int) -> str:
    return ("CASE " + " ".join(f"WHEN tier = '{k}' THEN '{v[idx]}'" for k, v in K.JOB_ACTIONS.items()) + " END")


@query("neighbour_vote", "J13 E5 E6",
       O.with_(KNN_CTES + ["v AS (SELECT query_id, sum(had_sepsis) AS sepsis_count, count(*) AS neighbours, "
                           "avg(total_icu_hours) AS avg_icu_hours FROM nb GROUP BY query_id)",
                           "vt AS (SELECT *, CASE WHEN sepsis_count >= 5 THEN 'HIGH RISK' WHEN sepsis_count >= 2 "
                           "THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS tier FROM v)"],
               "SELECT query_id, CAST(sepsis_count AS BIGINT) AS sepsis_count, CAST(neighbours AS BIGINT) AS neighbours, "
               "CAST(" + O.bround_sql("sepsis_count / greatest(neighbours, 1) * 100e0", 0) + " AS BIGINT) AS risk_pct, "
               "round(avg_icu_hours, 6) AS avg_icu_hours, tier AS risk_level, " + _job_case(0) + " AS recommendation, "
               + _job_case(1) + " AS action, CASE tier " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.API_ACTIONS.items())
               + " END AS api_action FROM vt"))
def q_neighbour_vote(spark, sf_dir):
    return finish(neighbors.neighbour_vote(lookalikes(spark, sf_dir)))


@query("knn_join_all", "J12 G5",
       O.with_(O.FEATURE_CTES + [PROFILE_SQL, STATS_SQL] + [
           "z AS (SELECT patient_id, " + ", ".join(f"(prof.{c} - st.m_{c}) / st.s_{c} AS {c}" for c in PF)
           + " FROM prof, st)",
           "d AS (SELECT q.patient_id AS query_id, p.patient_id, "
           + " + ".join(f"(q.{c} - p.{c}) * (q.{c} - p.{c})" for c in PF)
           + " AS d2 FROM z q JOIN z p ON q.patient_id <> p.patient_id)",
           "nb AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d2, patient_id) AS rank FROM d)"],
           "SELECT query_id, CAST(rank AS BIGINT) AS rank, patient_id, round(sqrt(d2), 6) AS distance FROM nb "
           "WHERE rank <= 10"))
def q_knn_join_all(spark, sf_dir):
    """Look-alikes of every entity: all profiles are probes."""
    prof = cut_lineage(profiles(spark, sf_dir))
    found = knn_join.knn_join(prof, prof.withColumnRenamed("patient_id", "query_id"), PF, K.KNN_K)
    return finish(found)


# ---------------------------------------------------------------- fitted models (rows-only)

def _train_test(spark, sf_dir):
    """Ordered 80/20 split of the next-hour table, scaled with train moments.

    The table is written once: the split, the moments and every fit read it again."""
    nh = cut_lineage(next_hour(spark, sf_dir))
    train, test = split.ordered_split(nh, S, K.TEST_FRACTION)
    mom = models.scaler_moments(train, K.FEATURE_COLS)
    prep = lambda d: models.assemble(models.apply_scaler(d, mom), K.FEATURE_COLS)
    return prep(train), prep(test), mom


@query("classifier_fits", "J1 J2 J3 J4 J5 F9 F10 M1 M3 M4 M6 H6")
def q_classifier_fits(spark, sf_dir):
    train, test, _ = _train_test(spark, sf_dir)
    train = agg.class_weights(train.withColumn("label", F.col("sepsislabel").cast("double")), "label", "w_bal")
    train = agg.positive_weight(train, "label", "w_pos")
    test = test.withColumn("label", F.col("sepsislabel").cast("double"))
    fitted = models.classifiers(train, models.Presets.published())
    parts = []
    for name, m in fitted.items():
        p = models.positive_probability(m.transform(test))
        parts.append(p.select(F.lit(name).alias("model"), "label", F.col("prob").alias("score"),
                              F.col("prediction").cast("int").alias("pred")))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    return finish(M.classifier_leaderboard(cut_lineage(scored)))  # several passes follow


def _regressor_scores(spark, sf_dir, names: tuple[str, ...]) -> DataFrame:
    """Regressors fitted at the published settings, scored on the held-out rows."""
    train, test, _ = _train_test(spark, sf_dir)
    train = train.select("features", F.col("hr_next_hour").alias("target"))
    test = test.select("features", F.col("hr_next_hour").alias("target"))
    fitted = models.regressors(train, models.Presets.published(), "features", "target", names)
    wide = test
    for i, m in enumerate(fitted.values()):  # one pass over the rows for all candidates
        wide = m.setPredictionCol(f"p{i}").transform(wide)
    pred = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"p{i}").alias("pred"))
                               for i, n in enumerate(fitted)]))
    scored = wide.select(F.col("target").alias("y"), pred.alias("x")).select("y", "x.*")
    return finish(M.regression_metrics(scored, "y", "pred", ["model"]))


@query("regressor_fits", "J6 J7 M5 M6 D4")
def q_regressor_fits(spark, sf_dir):
    """Ridge and boosted trees; the forest is a query of its own."""
    return _regressor_scores(spark, sf_dir, ("Ridge Regression", "XGBoost"))


@query("forest_regressor_fit", "J7 M5 D4")
def q_forest_regressor_fit(spark, sf_dir):
    return _regressor_scores(spark, sf_dir, ("Random Forest",))


@query("kmeans_segments", "J8 J9 F2 H5 G4 H2")
def q_kmeans_segments(spark, sf_dir):
    train, _, _ = _train_test(spark, sf_dir)
    km = models.kmeans_fit(train, K.KMEANS_K, restarts=K.KMEANS_RESTARTS)
    centres = [list(map(float, c)) for c in km.clusterCenters()]
    assigned = models.assign_nearest(train, centres, K.FEATURE_COLS, "cluster")
    raw = assigned  # scaled columns; profile on the scaled panel plus outcome
    prof = agg.segment_profile(raw, "cluster")
    labels = models.segment_labels(prof)
    out = prof.join(F.broadcast(labels.select("cluster", "risk_label")), on="cluster", how="inner")
    return finish(out.select("cluster", "patient_count", "sepsis_rate", "risk_label"))


@query("pca_summary", "J10 H4 F8 F12")
def q_pca_summary(spark, sf_dir):
    train, _, mom = _train_test(spark, sf_dir)
    res = models.pca_fit(train.drop("features"), K.FEATURE_COLS)
    top = models.top_loadings(res, K.FEATURE_COLS, spark, 5)
    proj = models.project(train, res.loadings[:2], K.FEATURE_COLS)
    sep = agg.group_separation(proj, ["pc1", "pc2"])
    ev = spark.createDataFrame(
        [("PC1", float(res.explained[0])), ("PC2", float(res.explained[1])),
         ("total_2", float(res.explained[:2].sum())),
         ("components_80pct", float(models.components_for(res.cumulative, 0.80))),
         ("components_95pct", float(models.components_for(res.cumulative, 0.95)))],
        "metric string, value double")
    sep = sep.select(F.concat(F.lit("separation_"), F.col("component")).alias("metric"), F.col("separation").alias("value"))
    tops = top.select(F.concat(F.col("component"), F.lit("_top"), F.col("rank").cast("string"), F.lit("_"), F.col("feature")).alias("metric"),
                      F.abs("loading").alias("value"))
    return finish(ev.unionByName(sep).unionByName(tops))


@query("fitted_forecasters", "J11 D5 D6 M5 I1")
def q_fitted_forecasters(spark, sf_dir):
    lags = forecast.lag_names()
    w = cut_lineage(hr_windows(spark, sf_dir).select("*", *windows.window_summary(lags)))
    train, test = split.ordered_split(w, S, train_fraction=0.8)
    feat_a, feat_c = lags, lags + ["w_mean", "w_std", "w_trend"]
    tr_a, te_a = models.assemble(train, feat_a, "fa"), models.assemble(test, feat_a, "fa")
    ols = models.linear_windows(tr_a, "fa")
    tr_c, te_c = models.assemble(train, feat_c, "fc"), models.assemble(test, feat_c, "fc")
    gbt = models.boosted_windows(tr_c, models.Presets.published(), "fc")
    scored = (ols.transform(te_a).select(F.lit("Linear Trend").alias("model"), "y", F.col("prediction").alias("pred"))
              .unionByName(test.select(F.lit("Exp Smoothing").alias("model"), "y",
                                       forecast.smoothing_forecast(lags).alias("pred")))
              .unionByName(gbt.transform(te_c).select(F.lit("XGBoost TS").alias("model"), "y",
                                                      F.col("prediction").alias("pred"))))
    return finish(M.regression_metrics(scored, "y", "pred", ["model"]))


@query("recursive_tree_forecast", "J14 J11 D6 E12")
def q_recursive_tree_forecast(spark, sf_dir):
    """Six-step recursive forecast with the boosted window model (lags + summary)."""
    w = cut_lineage(hr_windows(spark, sf_dir))
    lags = forecast.lag_names()
    train, _ = split.ordered_split(w, S, train_fraction=0.8)
    train = models.assemble(train.select("*", *windows.window_summary(lags)),
                            lags + ["w_mean", "w_std", "w_trend"])
    gbt = models.boosted_windows(train, models.Presets.published())
    out = forecast.recursive_model_forecast(gbt, w.select("patient_id", "iculos", *lags), lags)
    steps = [f"f{i}" for i in range(1, 7)]
    out = out.select("patient_id", "iculos", *[F.bround(c, 1).alias(c) for c in steps])
    return finish(out.select("*", *forecast.forecast_alerts(steps)))


def _embedding_columns(spark, sf_dir):
    from panelkit.sources.tables import read_table
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"])
    dims = emb.agg(F.max(F.size("embedding")).alias("d")).first()["d"] or 0
    cols = [f"e_{i:02d}" for i in range(dims)]
    flat = emb.select(F.col("vec_id").cast("string").alias("vec_key"), "vec_id", "label",
                      *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    return flat, cols


EMB_SQL = [
    "e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i "
    "FROM embeddings)",
    "c AS (SELECT label, i, avg(v) AS cv FROM e GROUP BY label, i)",
    "d AS (SELECT 'label_' || CAST(c.label AS VARCHAR) AS query_id, c.label AS probe_label, e.vec_id, "
    "any_value(e.label) AS label, sum((e.v - c.cv) * (e.v - c.cv)) AS d2 "
    "FROM e JOIN c ON e.i = c.i GROUP BY 1, 2, 3)",
    "nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d2, CAST(vec_id AS VARCHAR)) "
    "AS rank FROM d) t WHERE rank <= 10)",
]


@query("knn_embedding_centroids", "J12 J13 G5",
       O.with_(EMB_SQL, "SELECT query_id, CAST(count(*) AS BIGINT) AS neighbours, "
               "CAST(sum(CASE WHEN label = probe_label THEN 1 ELSE 0 END) AS BIGINT) AS same_label, "
               "round(avg(sqrt(d2)), 6) AS mean_distance, round(max(sqrt(d2)), 6) AS max_distance FROM nb GROUP BY query_id"))
def q_knn_embedding_centroids(spark, sf_dir):
    """k-NN on vectors: the 10 embeddings nearest to each label's centroid
    (probes derived from the data, bounded by the label domain), and how many
    of them carry that label."""
    flat, cols = _embedding_columns(spark, sf_dir)
    centroids = flat.groupBy("label").agg(*[F.avg(c).alias(c) for c in cols]).select(
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("query_id"),
        F.col("label").alias("probe_label"), *cols)
    nb = neighbors.knn(flat, centroids, cols, k=10, profile_key="vec_key", standardize=False,
                       exclude_self=False)
    nb = nb.withColumn("probe_label", F.regexp_extract("query_id", r"label_(-?\d+)", 1).cast("int"))
    return finish(nb.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("neighbours"),
        F.sum(F.when(F.col("label") == F.col("probe_label"), 1).otherwise(0)).alias("same_label"),
        F.avg("distance").alias("mean_distance"), F.max("distance").alias("max_distance")))


def q_assessment(spark, sf_dir):
    """Registered in ``q_scoring``, which imports this module."""
    from panelkit.plans import q_scoring
    return q_scoring.q_assessment(spark, sf_dir)
