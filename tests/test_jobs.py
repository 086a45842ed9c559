"""End-to-end jobs on generated entity files and on the events panel."""

import pytest
from pyspark.sql import functions as F

from panelkit.plans import jobs
from panelkit.plans.q_panel import features as events_features

from conftest import SF_SMALL


def test_features_job_equals_query_path(spark, tmp_path):
    from panelkit.sources.tables import panel_from_events
    panel_path = str(tmp_path / "panel")
    panel_from_events(spark, SF_SMALL).write.parquet(panel_path)
    for chunk in (10_000, 20):  # plain plan, then every entity chunked
        spark.sql("DROP TABLE IF EXISTS patient_features")
        got = jobs.features(spark, panel_path, str(tmp_path / f"out{chunk}"), buckets=4, chunk_rows=chunk)
        want = events_features(spark, SF_SMALL)
        cols = sorted(want.columns)
        diff = got.select(*cols).exceptAll(want.select(*cols)).count()
        assert diff == 0 and got.count() == want.count()
    spark.sql("DROP TABLE IF EXISTS patient_features")


def test_gate_forecast_rules_jobs(spark, tmp_path):
    feats = events_features(spark, SF_SMALL)
    summary = jobs.gate(spark, feats, min_rows=100)
    assert summary.filter(F.col("check_name") == "all_passed").first()["passed"]
    with pytest.raises(AssertionError):
        jobs.gate(spark, feats, min_rows=10**9)
    ts = jobs.forecast_job(spark, feats, str(tmp_path))
    assert ts.count() == 2
    r = jobs.rules(spark, feats, str(tmp_path))
    assert r.count() > 0
    assert spark.read.json(str(tmp_path / "metrics" / "rules")).count() == 5


def test_lookalike_job(spark, tmp_path):
    from panelkit.plans.q_models import probes
    feats = events_features(spark, SF_SMALL)
    vote = jobs.lookalikes(spark, feats, probes(spark), str(tmp_path))
    rows = {r["query_id"]: r for r in vote.collect()}
    assert set(rows) == {"probe_high_risk", "probe_defaults"}
    assert all(r["neighbours"] == 10 for r in rows.values())
    assert spark.read.json(str(tmp_path / "metrics" / "recommendation")).count() == 2


def test_train_job_writes_models_metrics_manifest(spark, tmp_path):
    import json
    import os
    from panelkit.operators.models import Presets
    feats = events_features(spark, SF_SMALL)
    presets = Presets(lr_max_iter=10, rf_trees=3, rf_depth=3, xgb_rounds=3, gb_rounds=3,
                      reg_trees=3, reg_rounds=3, kmeans_restarts=1, kmeans_iter=5)
    manifest = jobs.train(spark, feats, str(tmp_path), presets)
    n = feats.count() - feats.select("patient_id").distinct().count()   # rows with a next hour
    assert manifest["train_rows"] + manifest["test_rows"] == n
    assert manifest["test_rows"] == -(-2 * n // 10)          # ceil(0.2 n)
    assert manifest["best_model"] in {"Logistic Regression", "Random Forest", "XGBoost", "Gradient Boosting"}
    assert 1 <= manifest["components_for_80pct"] <= manifest["components_for_95pct"] <= 28
    board = spark.read.json(str(tmp_path / "metrics" / "classification"))
    assert board.count() == 4
    assert sorted(os.listdir(tmp_path / "models")) == ["gradient_boosting", "logistic_regression",
                                                       "random_forest", "xgboost"]
    doc = json.loads(spark.read.text(str(tmp_path / "manifest")).first()[0])
    assert doc["train_rows"] == manifest["train_rows"]


def test_forecast_job_fits_chooses_and_saves(spark, tmp_path):
    import json
    from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
    from panelkit.operators.models import Presets
    jobs.forecast_job(spark, events_features(spark, SF_SMALL), str(tmp_path), Presets(reg_rounds=2, xgb_depth=2))
    rmse = {r["model"]: r["rmse"] for r in spark.read.json(str(tmp_path / "metrics" / "timeseries")).collect()}
    assert set(rmse) == {"Linear Trend", "Exp Smoothing", "XGBoost TS", "Last Value"}
    best = json.loads(spark.read.text(str(tmp_path / "metrics" / "best_timeseries")).first()[0])
    del rmse["Last Value"]
    assert best["best_model"] == min(rmse, key=rmse.get)
    kinds = {"Linear Trend": LinearRegressionModel, "XGBoost TS": GBTRegressionModel}
    if best["best_model"] in kinds:
        kinds[best["best_model"]].load(str(tmp_path / "models" / "best_timeseries"))


def test_train_job_saves_the_other_models(spark, tmp_path):
    import os
    from pyspark.ml.clustering import KMeansModel
    from panelkit.operators.models import Presets
    presets = Presets(lr_max_iter=2, rf_trees=1, rf_depth=2, reg_depth=2, xgb_rounds=1, xgb_depth=2, gb_rounds=1, gb_depth=2,
                      reg_trees=1, reg_rounds=1, kmeans_restarts=1, kmeans_iter=2)
    manifest = jobs.train(spark, events_features(spark, SF_SMALL), str(tmp_path), presets)
    assert sorted(os.listdir(tmp_path / "regressors")) == ["random_forest", "ridge_regression", "xgboost"]
    rmse = {r["model"]: r["rmse"] for r in spark.read.json(str(tmp_path / "metrics" / "regression")).collect()}
    assert manifest["best_regressor"] == min(rmse, key=rmse.get)
    assert len(KMeansModel.load(str(tmp_path / "kmeans")).clusterCenters()) == 4
    assert spark.read.parquet(str(tmp_path / "pca")).count() == 28
