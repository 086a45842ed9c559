"""One saved scoring pipeline for batch and stream (J16, J17, ST1).

``pipeline`` puts the fitted parts (scaler moments, classifier, regressor,
segment centres and names, loadings) into one ``PipelineModel``; the training
job saves it, and every scoring job, batch or stream, loads it with ``load``
and calls ``transform``. Nothing is fitted when rows are scored.

The stages are column expressions with their parameters as literals (plus the
fitted Spark ML models), so scoring has no shuffle and works on a stream. A
feature that is missing (null or NaN) scores as 0, as after the feature table's
final zero-fill. Input columns stay, except those named like a result
(``RESULTS``, any case), which the result replaces. Columns named ``_sc_*`` are
the stages' own; rows that bring such a column, or lack a feature, are refused.
An empty table gives an empty result; repeated rows are scored each.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import scalar as X
from panelkit.operators import models

OWN = "_sc_"
RESULTS = ["probability", "risk_level", "action", "alerts", "next_hour", "change", "trend", "status",
           "segment", "segment_name", "pc1", "pc2", "zone"]


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose settings are saved as JSON parameters."""

    def __init__(self, **settings):
        super().__init__()
        self._set(**settings)

    def _of(self, name: str):
        return self.getOrDefault(name)


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.identity)


def _filled(c: str) -> Column:
    """A feature as double, missing values as 0."""
    d = F.col(f"`{c}`").cast("double")
    return F.when(d.isNull() | F.isnan(d), F.lit(0.0)).otherwise(d)


class Scale(_Stage):
    """``_sc_<feature>`` = (feature - mean) / std."""
    columns = _param("columns", "feature names")
    means = _param("means", "training means")
    stds = _param("stds", "training standard deviations")

    def _transform(self, rows: DataFrame) -> DataFrame:
        have = {c.lower() for c in rows.columns}
        lacking = [c for c in self._of("columns") if c.lower() not in have]
        if lacking:
            raise ValueError(f"features missing: {', '.join(lacking)}")
        clash = [c for c in rows.columns if c.lower().startswith(OWN)]
        if clash:
            raise ValueError(f"column names reserved for scoring: {', '.join(clash)}")
        return rows.select("*", *[((_filled(c) - F.lit(m)) / F.lit(s)).alias(OWN + c) for c, m, s in
                                  zip(self._of("columns"), self._of("means"), self._of("stds"))])


class LinearScore(_Stage):
    """A linear model of given coefficients over the scaled features:
    ``output`` = bias + sum(weight * feature), through the logistic function if asked."""
    columns = _param("columns", "feature names")
    weights = _param("weights", "one weight a feature")
    bias = _param("bias", "constant term")
    logistic = _param("logistic", "whether the sum goes through the logistic function")
    output = _param("output", "name of the new column")

    def _transform(self, rows: DataFrame) -> DataFrame:
        e = F.lit(float(self._of("bias")))
        for c, w in zip(self._of("columns"), self._of("weights")):
            e = e + F.col(OWN + c) * F.lit(float(w))
        if self._of("logistic"):
            e = F.lit(1.0) / (F.lit(1.0) + F.exp(-e))
        return rows.withColumn(self._of("output"), e)


class PositiveProbability(_Stage):
    """The positive class's entry of a classifier's probability vector."""

    def _transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(OWN + "prob", vector_to_array(F.col(OWN + "vector"))[1])


class Segments(_Stage):
    """Distance to every centre, nearest one (ties: lowest id) and its name."""
    columns = _param("columns", "feature names")
    centres = _param("centres", "one list of coordinates a centre")
    names = _param("names", "one name a centre")

    def _transform(self, rows: DataFrame) -> DataFrame:
        centres, names = self._of("centres"), self._of("names")
        scaled = [OWN + c for c in self._of("columns")]
        dist = models.centre_distances(centres, scaled)
        rows = rows.select("*", *[d.alias(f"{OWN}dist_{i}") for i, d in enumerate(dist)])
        nearest = F.array_min(F.array(*[F.struct(F.col(f"{OWN}dist_{i}").alias("d"), F.lit(i).alias("id"))
                                        for i in range(len(centres))]))["id"]
        rows = rows.withColumn(OWN + "segment", nearest)
        return rows.withColumn(OWN + "name", X.lookup(OWN + "segment", dict(enumerate(names)), "Unknown"))


class Project(_Stage):
    """Coordinates on the first two components."""
    columns = _param("columns", "feature names")
    loadings = _param("loadings", "two lists of loadings")

    def _transform(self, rows: DataFrame) -> DataFrame:
        return models.project(rows, self._of("loadings"), [OWN + c for c in self._of("columns")], OWN + "pc")


class Present(_Stage):
    """Tier, action, alerts, trend, status and zone; drops the stages' own columns."""
    segments = _param("segments", "number of segments")

    def _transform(self, rows: DataFrame) -> DataFrame:
        new = RESULTS + [f"dist_{i}" for i in range(self._of("segments"))]
        kept = [F.col(f"`{c}`") for c in rows.columns if not c.startswith(OWN) and c.lower() not in new]
        now, tier = _filled("hr"), X.probability_tier(OWN + "prob")
        return rows.select(
            *kept,
            F.round(OWN + "prob", 4).alias("probability"), tier.alias("risk_level"),
            X.api_action(tier).alias("action"), F.concat_ws(", ", X.alert_list()).alias("alerts"),
            F.bround(OWN + "next_hr", 1).alias("next_hour"),
            F.bround(F.col(OWN + "next_hr") - now, 1).alias("change"),
            X.trend_label(OWN + "next_hr", now).alias("trend"), X.hr_status(OWN + "next_hr").alias("status"),
            F.col(OWN + "segment").alias("segment"), F.col(OWN + "name").alias("segment_name"),
            *[F.round(f"{OWN}dist_{i}", 3).alias(f"dist_{i}") for i in range(self._of("segments"))],
            F.round(OWN + "pc1", 4).alias("pc1"), F.round(OWN + "pc2", 4).alias("pc2"),
            X.zone(OWN + "pc1", OWN + "pc2").alias("zone"))


def fitted_stages(classifier, regressor, columns: list[str] = K.FEATURE_COLS) -> list:
    """Stages of a fitted classifier and regressor (copies; the models stay as they are)."""
    vector = VectorAssembler(inputCols=[OWN + c for c in columns], outputCol=OWN + "features", handleInvalid="keep")
    clf = classifier.copy().setFeaturesCol(OWN + "features").setProbabilityCol(OWN + "vector") \
        .setRawPredictionCol(OWN + "raw").setPredictionCol(OWN + "class")
    reg = regressor.copy().setFeaturesCol(OWN + "features").setPredictionCol(OWN + "next_hr")
    return [vector, clf, PositiveProbability(), reg]


def linear_stages(weights: list[float], bias: float, next_weights: list[float], next_bias: float,
                  columns: list[str] = K.FEATURE_COLS) -> list:
    """Stages of a logistic and a linear model given by their coefficients."""
    return [LinearScore(columns=columns, weights=weights, bias=bias, logistic=True, output=OWN + "prob"),
            LinearScore(columns=columns, weights=next_weights, bias=next_bias, logistic=False,
                        output=OWN + "next_hr")]


def pipeline(moments: dict[str, tuple[float, float]], score_stages: list, centres: list[list[float]],
             names: dict[int, str], loadings, columns: list[str] = K.FEATURE_COLS) -> PipelineModel:
    """Scaler, ``score_stages`` (``fitted_stages`` or ``linear_stages``), segments, projection, results."""
    return PipelineModel([
        Scale(columns=columns, means=[moments[c][0] for c in columns], stds=[moments[c][1] for c in columns]),
        *score_stages,
        Segments(columns=columns, centres=[[float(v) for v in c] for c in centres],
                 names=[names.get(i, "Unknown") for i in range(len(centres))]),
        Project(columns=columns, loadings=[[float(v) for v in row] for row in loadings[:2]]),
        Present(segments=len(centres))])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# fixed values: the two reference rows of the output checks, in FEATURE_COLS order
NORMAL_ROW = [75, 97, 37.0, 120, 80, 70, 16, 50, 1, 75, 74, 120, 80, 16,
              0, 0, 0, 0, 2, 2, 0, 0, 0, 0, 0, 0, 0, 4]
HIGH_RISK_ROW = [115, 88, 39.2, 85, 58, 45, 28, 72, 1, 110, 105, 90, 62, 26,
                 5, -8, 0.5, 3, 8, 10, 1, 1, 1, 0, 1, 1, 3, 12]


def output_checks(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Q6: range checks of every scored row in one aggregate, and the order of
    the two reference rows: ``check_name, failing, passed``. An empty table
    fails no range check."""
    s = model.transform(rows)
    n_seg = sum(c.startswith("dist_") and c[5:].isdigit() for c in s.columns)
    bad = {"probability_in_unit_interval": ~F.col("probability").between(0.0, 1.0),
           "next_hour_is_number": F.isnan("next_hour"),
           "next_hour_in_range": ~F.col("next_hour").between(*K.HR_RANGE),
           "segment_known": ~F.col("segment").between(0, n_seg - 1),
           "two_coordinates": F.isnan("pc1") | F.isnan("pc2")}
    counted = s.agg(*[F.count(F.when(F.coalesce(b, F.lit(True)), 1)).alias(name) for name, b in bad.items()])
    long = counted.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failing"))
                                              for name in bad])).alias("x")).select("x.*")
    schema = "which string, " + ", ".join(f"{c} double" for c in K.FEATURE_COLS)
    two = rows.sparkSession.createDataFrame([("normal", *map(float, NORMAL_ROW)), ("high", *map(float, HIGH_RISK_ROW))],
                                            schema)
    p = model.transform(two)
    gap = (F.max(F.when(F.col("which") == "high", F.col("probability")))
           - F.max(F.when(F.col("which") == "normal", F.col("probability"))))
    order = p.agg(gap.alias("gap")).select(F.lit("high_risk_above_normal").alias("check_name"),
                                           F.when(F.col("gap") > 0, 0).otherwise(1).cast("long").alias("failing"))
    return long.unionByName(order).withColumn("passed", F.col("failing") == 0)
