"""End-to-end jobs P1-P7, each runnable with ``spark-submit``.

    spark-submit panelkit/plans/jobs.py <job> --input <dir> --output <dir> [options]

Jobs hand over through tables written under ``--output`` (parquet), never
through the driver. The session's ``spark.checkpoint.dir`` is used for
intermediate state; it is only set here when the cluster left it unset.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.config import shared_dir
from panelkit.operators import aggregate as agg
from panelkit.operators import clean, forecast, metrics as M, mining, models, neighbors, quality, scoring, skew, split, windows
from panelkit.operators.panel import PanelSpec
from panelkit.sources import files, sinks
from panelkit.streaming import stateful

SPEC = PanelSpec("patient_id", ("iculos",))


def ingest(spark: SparkSession, raw_dir: str, out: str, sep: str = "|", fill_global_median: bool = False) -> DataFrame:
    """Entity files -> imputed panel (C1 vitals, C2 labs) + quarantine of
    malformed lines. A vital that an entity lacks wholly stays missing, unless
    ``fill_global_median`` (C3) is asked for. Returns the written panel."""
    panel, quarantine = files.read_panel_files(spark, raw_dir, sep)
    vitals = [c for c in K.VITALS_LC if c in panel.columns]
    labs = [c for c in K.LABS_LC if c in panel.columns]
    imputed = clean.impute(panel, SPEC, vitals, labs)
    if fill_global_median:
        imputed = clean.fill_median(imputed, vitals)
    sinks.write_clean(imputed.drop("_metadata"), f"{out}/patient_vitals")
    sinks.write_clean(quarantine, f"{out}/quarantine")
    return spark.read.parquet(f"{out}/patient_vitals")


def features(spark: SparkSession, panel_path: str, out: str, buckets: int = 64,
             chunk_rows: int = skew.DEFAULT_CHUNK_ROWS, min_rows: int | None = None) -> DataFrame:
    """Panel -> feature table, written bucketed by entity.

    The panel already has its ordinal; hot entities are chunked (skew). With
    ``min_rows`` the quality gate is observed while the table is written, with
    no scan of its own: ``out``/metrics/feature_gate, and an error (the jobs
    behind it do not start) when a check fails."""
    gated = min_rows is not None
    panel = (_own_session(spark) if gated else spark).read.parquet(panel_path)
    imputed, chunked = skew.ordinal_and_impute(
        panel, "patient_id", ["iculos"],
        [c for c in K.VITALS_LC if c in panel.columns], [c for c in K.LABS_LC if c in panel.columns],
        "_ord", chunk_rows)
    if chunked:
        halo, spec = skew.with_halo(imputed, "patient_id", "_ord", chunk_rows, back=5)
        feats = windows.add_features(halo, spec, hours_col="iculos")
        feats = skew.drop_halo(feats.withColumn("_again", quality.repeats_previous(spec, "iculos")))
    else:
        feats = windows.add_features(imputed, SPEC).withColumn("_again", quality.repeats_previous(SPEC, "iculos"))
    feats = feats.drop("_ord")
    feats = feats.na.fill(0.0)
    if gated:
        feats, seen = quality.observe(feats, gate_conditions() | {"grain_unique": F.col("_again")}, "sepsislabel")
    feats = feats.drop("_again")
    feats.write.mode("overwrite").bucketBy(buckets, "patient_id").sortBy("patient_id", "iculos") \
        .option("path", f"{out}/patient_features").saveAsTable("patient_features")
    spark.catalog.refreshTable("patient_features")
    if gated:
        checks = quality.observed_summary(spark, seen, min_rows, "panel_rows_above_floor", "both_classes_present")
        checks.coalesce(1).write.mode("overwrite").json(f"{out}/metrics/feature_gate")
        quality.assert_passed(checks)
    return spark.table("patient_features")


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings and catalog for observed writes: a session that
    has observed metrics cannot send freshly fitted models, which refer to it, to tasks."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def gate_conditions() -> dict:
    """Rows that a feature table must not have, by check."""
    score = agg.risk_score()
    return {"no_null_vitals": clean.any_null(["hr", "temp", "o2sat"]),
            "score_in_unit_interval": (score < 0.0) | (score > 1.0)}


def train(spark: SparkSession, feats: DataFrame, out: str, presets: models.Presets) -> dict:
    """Next-hour target, ordered split, scaler, classifiers, regressors,
    segments, PCA; metrics and models written under ``out``, and the scoring
    pipeline of the best of them under ``out``/scoring."""
    nh = windows.lead_target(feats, SPEC)
    tr, te = split.ordered_split(nh, SPEC, K.TEST_FRACTION)
    mom = models.scaler_moments(tr, K.FEATURE_COLS)
    prep = lambda d: models.assemble(models.apply_scaler(d, mom), K.FEATURE_COLS)
    tr, te = prep(tr).cache(), prep(te).cache()
    lab = tr.withColumn("label", F.col("sepsislabel").cast("double"))
    lab = agg.positive_weight(agg.class_weights(lab, "label", "w_bal"), "label", "w_pos")
    clfs = models.classifiers(lab, presets)
    test = te.withColumn("label", F.col("sepsislabel").cast("double"))
    scored = None
    for name, m in clfs.items():
        p = models.positive_probability(m.transform(test)).select(
            F.lit(name).alias("model"), "label", F.col("prob").alias("score"),
            F.col("prediction").cast("int").alias("pred"))
        scored = p if scored is None else scored.unionByName(p)
        sinks.save_model(m, f"{out}/models/{name.replace(' ', '_').lower()}")
    board = M.classifier_leaderboard(scored)
    board.write.mode("overwrite").json(f"{out}/metrics/classification")
    regs = models.regressors(tr.withColumn("target", F.col("hr_next_hour")), presets)
    rs = None
    for name, m in regs.items():
        p = m.transform(te).select(F.lit(name).alias("model"), F.col("hr_next_hour").alias("y"),
                                   F.col("prediction").alias("pred"))
        rs = p if rs is None else rs.unionByName(p)
        sinks.save_model(m, f"{out}/regressors/{name.replace(' ', '_').lower()}")
    reg_board = M.regression_metrics(rs, "y", "pred", ["model"])
    reg_board.write.mode("overwrite").json(f"{out}/metrics/regression")
    order = F.array_position(F.array(*[F.lit(n) for n in regs]), F.col("model"))
    best_reg = M.best_by(spark.read.json(f"{out}/metrics/regression").withColumn("ordinal", order), "rmse",
                         maximize=False, ordinal="ordinal").first()
    km = models.kmeans_fit(tr, K.KMEANS_K, presets.kmeans_restarts, presets.kmeans_iter, presets.seed)
    sinks.save_model(km, f"{out}/kmeans")
    centres = [list(map(float, c)) for c in km.clusterCenters()]
    prof = agg.segment_profile(models.assign_nearest(tr, centres, K.FEATURE_COLS), "cluster")
    labels = models.segment_labels(prof)
    labels.write.mode("overwrite").json(f"{out}/metrics/segments")
    names = {r["cluster"]: r["risk_label"] for r in labels.collect()}  # one row a segment
    pca = models.pca_fit(tr.drop("features"), K.FEATURE_COLS)
    spark.createDataFrame([(i + 1, v.tolist(), float(pca.explained[i])) for i, v in enumerate(pca.loadings)],
                          "component int, loadings array<double>, explained double") \
        .write.mode("overwrite").parquet(f"{out}/pca")
    order = F.array_position(F.array(*[F.lit(n) for n in clfs]), F.col("model"))  # ties: the first candidate
    best = M.best_by(board.withColumn("ordinal", order), "medical_score", ordinal="ordinal").first()
    scoring.save(scoring.pipeline(mom, scoring.fitted_stages(clfs[best["best_model"]], regs[best_reg["best_model"]]),
                                  centres, names, pca.loadings), f"{out}/scoring")
    manifest = {"train_rows": tr.count(), "test_rows": te.count(),
                "best_model": best["best_model"], "best_medical_score": best["best_medical_score"],
                "best_regressor": best_reg["best_model"], "best_regressor_rmse": best_reg["best_rmse"],
                "pca_variance": [float(x) for x in pca.explained[:2]],
                "components_for_80pct": models.components_for(pca.cumulative, 0.8),
                "components_for_95pct": models.components_for(pca.cumulative, 0.95),
                "scaler": {c: list(v) for c, v in mom.items()}}
    sinks.write_json_document(spark, manifest, f"{out}/manifest")
    tr.unpersist()
    te.unpersist()
    return manifest


def score(spark: SparkSession, feats: DataFrame, model_path: str, out: str) -> DataFrame:
    """Every row of a feature table through the saved scoring pipeline (J16,
    J17), written as ``out``/assessments; the output checks (Q6) beside it."""
    model = scoring.load(model_path)
    model.transform(feats).write.mode("overwrite").parquet(f"{out}/assessments")
    scoring.output_checks(model, feats).write.mode("overwrite").json(f"{out}/metrics/output_checks")
    return spark.read.parquet(f"{out}/assessments")


def score_stream(spark: SparkSession, feats_path: str, model_path: str, out: str,
                 max_files: int | None = None) -> DataFrame:
    """The same for the files that the feature table got since the last run
    (checkpoint under ``out``): each row is scored and written once."""
    return stateful.assess_stream(spark, stateful.table_stream(spark, feats_path, max_files), model_path,
                                  out=f"{out}/assessments_stream", checkpoint=f"{out}/assessments_checkpoint")


def forecast_job(spark: SparkSession, feats: DataFrame, out: str, presets: models.Presets | None = None) -> DataFrame:
    """Sliding windows with their summary (D5, D6), time-ordered split,
    forecasters + metrics. With ``presets`` (the job always gives them) the
    fitted forecasters (J11 a, c) are scored too, and the best of the three is
    chosen by RMSE (H6), named in metrics/best_timeseries and saved; without,
    only those that need no fit are."""
    lags = forecast.lag_names()
    w = windows.sliding_windows(feats, SPEC, "hr", K.WINDOW_SIZE).select("*", *windows.window_summary(lags))
    tr, test = split.ordered_split(w, SPEC, train_fraction=0.8)
    smoothing = test.select(F.lit("Exp Smoothing").alias("model"), "y", forecast.smoothing_forecast(lags).alias("pred"))
    scored = smoothing.unionByName(test.select(F.lit("Last Value").alias("model"), "y", F.col("lag1").alias("pred")))
    fitted = {}
    if presets is not None:
        tr, test = tr.cache(), test.cache()
        wide = lags + ["w_mean", "w_std", "w_trend"]
        fitted = {"Linear Trend": (models.linear_windows(models.assemble(tr, lags)), lags),
                  "XGBoost TS": (models.boosted_windows(models.assemble(tr, wide), presets), wide)}
        for name, (m, cols) in fitted.items():
            scored = scored.unionByName(m.transform(models.assemble(test, cols)).select(
                F.lit(name).alias("model"), "y", F.col("prediction").alias("pred")))
    res = M.regression_metrics(scored, "y", "pred", ["model"])
    res.write.mode("overwrite").json(f"{out}/metrics/timeseries")
    if presets is not None:
        names = F.array(*[F.lit(n) for n in ("Linear Trend", "Exp Smoothing", "XGBoost TS")])
        board = spark.read.json(f"{out}/metrics/timeseries").withColumn("ordinal", F.array_position(names, F.col("model")))
        best = M.best_by(board.filter("ordinal > 0"), "rmse", maximize=False, ordinal="ordinal").first()
        sinks.write_json_document(spark, best.asDict(), f"{out}/metrics/best_timeseries")
        if best["best_model"] in fitted:  # smoothing has nothing to save
            sinks.save_model(fitted[best["best_model"]][0], f"{out}/models/best_timeseries")
        tr.unpersist()
        test.unpersist()
    return res


def lookalikes(spark: SparkSession, feats: DataFrame, queries: DataFrame, out: str) -> DataFrame:
    """P5: profiles, k nearest per query, neighbour vote."""
    prof = agg.entity_profile(feats, SPEC)
    prof = prof.select("patient_id", *[F.col(c).cast("double").alias(c) for c in K.PROFILE_FEATURES], "had_sepsis")
    nb = neighbors.knn(prof, queries, K.PROFILE_FEATURES, K.KNN_K)
    vote = neighbors.neighbour_vote(nb)
    vote.write.mode("overwrite").json(f"{out}/metrics/recommendation")
    return vote


def rules(spark: SparkSession, feats: DataFrame, out: str) -> DataFrame:
    """Event bins, balanced sample, itemsets, rules with fallback."""
    from panelkit.functions import scalar as X
    ev = feats.select("patient_id", "iculos", "sepsislabel", *X.event_bins())
    bal = split.balanced_sample(ev, ["patient_id", "iculos"], "sepsislabel", K.NEGATIVES_PER_POSITIVE)
    its = mining.frequent_itemsets(mining.transactions(bal))
    r = mining.rules_with_fallback(its)
    r.select("ante_key", "cons_key", "support", "confidence", "lift").write.mode("overwrite").json(f"{out}/rules")
    mining.rule_summary(bal, its, r).write.mode("overwrite").json(f"{out}/metrics/rules")
    return r


def gate(spark: SparkSession, feats: DataFrame, min_rows: int = K.MIN_PANEL_ROWS) -> DataFrame:
    """Data-quality gate; raises (non-zero exit) when a check fails."""
    checks = [quality.row_checks(feats, min_rows, gate_conditions(), "panel_rows_above_floor"),
              quality.both_classes(feats, "sepsislabel", "both_classes_present"),
              quality.grain_unique(feats, ["patient_id", "iculos"], "grain_unique")]
    summary = quality.summary(checks)
    quality.assert_passed(summary)
    return summary


def main(argv: list[str]) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("job", choices=["ingest", "features", "train", "score", "score-stream", "forecast", "lookalikes", "rules", "gate", "all"])
    ap.add_argument("--input", help="entity files (ingest, all), panel (features) or feature rows")
    ap.add_argument("--table", help="feature table of the catalog instead of --input: read by its buckets")
    ap.add_argument("--output", required=True)
    ap.add_argument("--quick-presets", action="store_true", help="small fits, for trials")
    ap.add_argument("--min-rows", type=int, default=K.MIN_PANEL_ROWS)
    ap.add_argument("--probes", help="parquet of look-alike probes: query_id + profile features")
    ap.add_argument("--models", help="saved scoring pipeline (default: <output>/scoring)")
    a = ap.parse_args(argv)
    if not a.input and (not a.table or a.job in ("ingest", "features", "score-stream", "all")):
        ap.error("--input is needed")
    spark = SparkSession.builder.appName(f"panelkit-{a.job}").getOrCreate()
    shared_dir(spark)
    presets = models.Presets() if a.quick_presets else models.Presets.published()
    if a.job in ("ingest", "all"):
        ingest(spark, a.input, a.output)
    feats_path = f"{a.output}/patient_vitals" if a.job == "all" else a.input
    if a.job in ("features", "all"):
        # before any training: bad features end the run here
        features(spark, feats_path, a.output, min_rows=a.min_rows if a.job == "all" else None)
    model_path = a.models or f"{a.output}/scoring"
    if a.job == "score-stream":
        score_stream(spark, a.input, model_path, a.output)
    if a.job in ("train", "score", "forecast", "lookalikes", "rules", "gate", "all"):
        table = "patient_features" if a.job == "all" else a.table
        feats = spark.table(table) if table else spark.read.parquet(a.input)
        if a.job in ("train", "all"):
            print(json.dumps(train(spark, feats, a.output, presets)))
        if a.job in ("score", "all"):
            score(spark, feats, model_path, a.output)
        if a.job in ("forecast", "all"):
            forecast_job(spark, feats, a.output, presets)
        if a.job in ("rules", "all"):
            rules(spark, feats, a.output)
        if a.job == "lookalikes" and not a.probes:
            ap.error("lookalikes needs --probes")
        if a.job == "all" and not a.probes:
            print("look-alikes left out: no --probes given", file=sys.stderr)
        if a.job in ("lookalikes", "all") and a.probes:
            lookalikes(spark, feats, spark.read.parquet(a.probes), a.output)
        if a.job in ("gate", "all"):  # last: the outputs of the other jobs exist by now
            gate(spark, feats, a.min_rows)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
