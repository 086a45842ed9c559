"""The saved scoring pipeline: load, batch = stream, edges, the scoring jobs."""

import pytest
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.operators import scoring
from panelkit.operators.models import Presets
from panelkit.plans import jobs
from panelkit.plans.q_panel import features
from panelkit.plans.q_scoring import given_pipeline

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def feats(spark):
    f = features(spark, SF_SMALL).cache()
    yield f
    f.unpersist()


@pytest.fixture(scope="module")
def saved(spark, feats, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scoring") / "model")
    scoring.save(given_pipeline(feats), path)
    return path


def row(spark, **change):
    vals = {c: float(v) for c, v in zip(K.FEATURE_COLS, scoring.HIGH_RISK_ROW)} | change
    return spark.createDataFrame([tuple(vals.values())], ", ".join(f"{c} double" for c in vals))


def result(model, df):
    return model.transform(df).select(*scoring.RESULTS).first()


def test_loaded_pipeline_scores_like_the_built_one(feats, saved):
    a, b = given_pipeline(feats).transform(feats), scoring.load(saved).transform(feats)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and a.count() == feats.count()


def test_scoring_plans_no_shuffle(spark, tmp_path, feats, saved):
    feats.write.parquet(str(tmp_path / "f"))
    plan = scoring.load(saved).transform(spark.read.parquet(str(tmp_path / "f")))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_missing_features_score_as_zero(spark, saved):
    model = scoring.load(saved)
    want = result(model, row(spark, hr=0.0, temp=0.0, flag_tachy=0.0))
    assert result(model, row(spark, hr=None, temp=float("nan"), flag_tachy=None)) == want


def test_clashing_names_empty_and_repeated_rows(spark, saved):
    model = scoring.load(saved)
    clash = row(spark).select("*", F.lit("x").alias("Probability"), F.lit(1).alias("zone"), F.lit(2).alias("extra"))
    got = model.transform(clash.unionAll(clash))
    assert [c.lower() for c in got.columns].count("probability") == 1 and got.columns.count("zone") == 1
    assert got.count() == 2 and got.distinct().count() == 1 and got.first()["extra"] == 2
    assert got.first()["probability"] == result(model, row(spark))["probability"]
    assert model.transform(row(spark).limit(0)).count() == 0
    with pytest.raises(ValueError, match="features missing: hr"):
        model.transform(row(spark).drop("hr"))
    with pytest.raises(ValueError, match="reserved"):
        model.transform(row(spark).withColumn("_sc_hr", F.lit(1.0)))


def test_ties_between_centres_take_the_lowest_id(spark, feats):
    m = {c: (0.0, 1.0) for c in K.FEATURE_COLS}
    same = [[1.0] * len(K.FEATURE_COLS)] * 3
    zero = [0.0] * len(K.FEATURE_COLS)
    model = scoring.pipeline(m, scoring.linear_stages(zero, 0.0, zero, 80.0), same, {0: "a", 1: "b"}, [zero, zero])
    got = model.transform(row(spark)).first()
    assert (got["segment"], got["segment_name"], got["probability"]) == (0, "a", 0.5)
    assert got["dist_0"] == got["dist_2"] and got["zone"] == "GREEN ZONE"


def test_jobs_train_score_and_stream(spark, tmp_path, feats):
    """P3 saves the pipeline of its best models; batch and stream load it and agree row by row,
    and a second stream run takes only the new files."""
    out, table = str(tmp_path / "out"), str(tmp_path / "feats")
    presets = Presets(lr_max_iter=5, rf_trees=2, rf_depth=2, reg_depth=2, xgb_rounds=1, xgb_depth=2, gb_rounds=1,
                      gb_depth=2, reg_trees=2, reg_rounds=1, kmeans_restarts=1, kmeans_iter=3)
    jobs.train(spark, feats, out, presets)
    half = F.col("iculos") <= 5
    feats.filter(half).write.parquet(table)
    first = jobs.score_stream(spark, table, f"{out}/scoring", out, max_files=1).count()
    assert first == feats.filter(half).count()
    feats.filter(~half).write.mode("append").parquet(table)
    streamed = jobs.score_stream(spark, table, f"{out}/scoring", out)
    batch = jobs.score(spark, spark.read.parquet(table), f"{out}/scoring", out)
    assert streamed.count() == batch.count() == feats.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    checks = {r["check_name"]: r["passed"] for r in spark.read.json(f"{out}/metrics/output_checks").collect()}
    assert set(checks) == {"probability_in_unit_interval", "next_hour_is_number", "next_hour_in_range",
                           "segment_known", "two_coordinates", "high_risk_above_normal"}
    assert checks["probability_in_unit_interval"] and checks["segment_known"] and checks["two_coordinates"]
