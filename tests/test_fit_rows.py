"""Iterative fits get all rows in few partitions."""

import pytest
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.operators import models


class Seen(Exception):
    pass


class Spy:
    def __init__(self, **settings):
        pass

    def fit(self, rows):
        raise Seen(rows.rdd.getNumPartitions(), rows.count())


def seen(fit, *args, **how):
    with pytest.raises(Seen) as e:
        fit(*args, **how)
    return e.value.args


def rows(spark):
    return models.assemble(spark.range(0, 3000, 1, 64).selectExpr(
        "double(id % 4) * 10 AS a", "double(id % 7) AS y", "double(id % 7) AS target", "double(id % 2) AS label",
        "1.0D AS w_bal", "1.0D AS w_pos"), ["a"])


def test_operators_gather_the_rows(spark, monkeypatch):
    for name in ("GBTRegressor", "RandomForestRegressor", "KMeans", "LogisticRegression"):
        monkeypatch.setattr(models, name, Spy)
    assert seen(models.boosted_windows, rows(spark)) == (1, 3000)
    assert seen(models.regressors, rows(spark), names=("XGBoost",)) == (1, 3000)
    assert seen(models.regressors, rows(spark), names=("Random Forest",)) == (1, 3000)
    assert seen(models.kmeans_fit, rows(spark), 4) == (1, 3000)
    assert seen(models.classifiers, rows(spark)) == (1, 3000)


def test_more_rows_get_more_partitions(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    out = models.fit_rows(spark.range(0, 3000, 1, 64))
    assert out.rdd.getNumPartitions() == min(30, models.FIT_TASKS * cores)
    assert sorted(r["id"] for r in out.collect()) == list(range(3000))
    assert models.fit_rows(spark.range(0)).count() == 0


def test_saved_pipeline_is_fitted_on_gathered_rows(spark, monkeypatch):
    from panelkit.plans import q_models, q_scoring
    panel = spark.range(0, 640, 1, 64).select(
        F.format_string("p%03d", F.col("id") % 20).alias("patient_id"), (F.col("id") / 20).cast("int").alias("iculos"),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(K.FEATURE_COLS)],
        (F.col("id") % 2).cast("int").alias("sepsislabel"), (F.col("id") % 50).cast("double").alias("hr_next_hour"))
    monkeypatch.setattr(q_models, "next_hour", lambda *_: panel)
    monkeypatch.setattr("pyspark.ml.classification.LogisticRegression", Spy)
    assert seen(q_scoring.fitted_pipeline, spark, "unused") == (1, 512)
