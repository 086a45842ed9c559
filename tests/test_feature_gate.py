"""The quality gate as metrics of the pass that writes the feature table."""

import pytest
from pyspark.sql import functions as F

from panelkit.plans import jobs
from panelkit.sources.tables import panel_from_events

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def panel(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gate") / "panel")
    panel_from_events(spark, SF_SMALL).write.parquet(path)
    yield path
    spark.sql("DROP TABLE IF EXISTS patient_features")


def checks(spark, out):
    return {r["check_name"]: (r["observed"], r["passed"]) for r in spark.read.json(f"{out}/metrics/feature_gate").collect()}


@pytest.mark.parametrize("chunk", [10_000, 20])      # plain plan; every entity cut into chunks
def test_observed_gate_equals_the_scanning_gate(spark, panel, tmp_path, chunk):
    spark.sql("DROP TABLE IF EXISTS patient_features")
    feats = jobs.features(spark, panel, str(tmp_path), buckets=4, chunk_rows=chunk, min_rows=100)
    want = {r["check_name"]: (r["observed"], r["passed"]) for r in jobs.gate(spark, feats, min_rows=100).collect()}
    assert checks(spark, tmp_path) == want and want["all_passed"] == (5.0, True)
    assert "_again" not in feats.columns


def test_bad_features_end_the_run_before_training(spark, panel, tmp_path, monkeypatch):
    """Repeated hours, and a third label: the run stops, and no training starts."""
    bad = spark.read.parquet(panel)
    again = bad.filter("iculos = 2").withColumn("sepsislabel", F.lit(2).cast(bad.schema["sepsislabel"].dataType))
    path, out = str(tmp_path / "bad"), str(tmp_path / "out")
    bad.unionByName(again).write.parquet(path)
    monkeypatch.setattr(jobs, "ingest", lambda spark, i, o: spark.read.parquet(i).write.parquet(f"{o}/patient_vitals"))
    monkeypatch.setattr(jobs, "train", lambda *a: pytest.fail("training started on bad features"))
    for chunk in (None, 20):
        spark.sql("DROP TABLE IF EXISTS patient_features")
        with pytest.raises(AssertionError, match="both_classes_present, grain_unique"):
            if chunk is None:
                jobs.main(["all", "--input", path, "--output", out, "--min-rows", "100", "--quick-presets"])
            else:
                jobs.features(spark, path, out, 4, chunk, min_rows=100)
        got = checks(spark, out)
        assert got["grain_unique"] == (float(again.count()), False) and got["both_classes_present"] == (3.0, False)
        assert got["panel_rows_above_floor"][1] and not got["all_passed"][1]
    with pytest.raises(AssertionError, match="panel_rows_above_floor"):
        spark.sql("DROP TABLE IF EXISTS patient_features")
        jobs.features(spark, panel, out, 4, min_rows=10**9)
