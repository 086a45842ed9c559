"""Scoring queries (J16, J17, ST1, Q6): every one loads a saved pipeline.

``assessment_fixed`` and ``stream_assessment`` use given coefficients, so that
SQL can state every column; ``assessment`` and ``output_checks`` use the fitted
models of the feature table (rows-only: their values depend on the optimiser).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.config import scratch_path
from panelkit.operators import aggregate as agg
from panelkit.operators import models, scoring
from panelkit.plans import oracle as O
from panelkit.plans.q_models import _train_test
from panelkit.plans.q_panel import features
from panelkit.plans.q_stream import FWD_CTES, events_glob
from panelkit.plans.registry import finish, query
from panelkit.streaming import stateful as ST

FC = K.FEATURE_COLS
DISTS = [f"dist_{i}" for i in range(K.KMEANS_K)]
OUT = ["patient_id", "iculos", "probability", "risk_level", "action", "alerts", "next_hour", "change", "trend",
       "status", "segment", "segment_name", *DISTS, "pc1", "pc2", "zone"]

# given coefficients, one a feature, by rule
WEIGHTS = [((7 * i) % 11 - 5) / 20 for i in range(len(FC))]
NEXT_WEIGHTS = [((5 * i) % 13 - 6) / 2 for i in range(len(FC))]
LOADINGS = [[((3 * i) % 7 - 3) / 10 for i in range(len(FC))], [((4 * i + 1) % 9 - 4) / 10 for i in range(len(FC))]]
CENTRES = [[((i * (j + 2)) % 5 - 2) / 4 for i in range(len(FC))] for j in range(K.KMEANS_K)]
BIAS, NEXT_BIAS = 0.1, 85.0

_SAVED: dict = {}


def _saved(spark, sf_dir: str, kind: str, build) -> str:
    """Path of the pipeline saved for this session, table folder and kind; built at the first call."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _SAVED:
        path = scratch_path(spark, f"scoring-{kind}")
        scoring.save(build(), path)
        _SAVED[key] = path
    return _SAVED[key]


def fitted_pipeline(spark, sf_dir: str):
    """Logistic regression, ridge, k-means and PCA of the training rows."""
    from pyspark.ml.classification import LogisticRegression
    train, _, mom = _train_test(spark, sf_dir)
    label = train.withColumn("label", F.col("sepsislabel").cast("double"))
    rows = models.fit_rows(agg.class_weights(label, "label", "w_bal")
                           .select("features", "label", "w_bal", F.col("hr_next_hour").alias("target")))
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w_bal", regParam=1.0 / rows.count(),
                            standardization=False, maxIter=models.Presets.published().lr_max_iter).fit(rows)
    reg = models.ridge(rows, 1.0)
    km = models.kmeans_fit(rows, K.KMEANS_K, restarts=K.KMEANS_RESTARTS)
    centres = [list(map(float, c)) for c in km.clusterCenters()]
    prof = agg.segment_profile(models.assign_nearest(train, centres, FC, "cluster"), "cluster")
    names = {r["cluster"]: r["risk_label"] for r in models.segment_labels(prof).collect()}  # one row a segment
    pca = models.pca_fit(train.drop("features"), FC, 2)
    return scoring.pipeline(mom, scoring.fitted_stages(lr, reg), centres, names, pca.loadings)


def given_pipeline(rows: DataFrame):
    """Given coefficients over the moments of ``rows``."""
    return scoring.pipeline(models.scaler_moments(rows, FC),
                            scoring.linear_stages(WEIGHTS, BIAS, NEXT_WEIGHTS, NEXT_BIAS),
                            CENTRES, dict(enumerate(K.SEGMENT_LABELS)), LOADINGS)


@query("assessment", "J16 J17 E4 E6 E7 E8 E10 Q5")
def q_assessment(spark, sf_dir):
    path = _saved(spark, sf_dir, "fitted", lambda: fitted_pipeline(spark, sf_dir))
    return finish(scoring.load(path).transform(features(spark, sf_dir)).select(*OUT))


@query("output_checks", "Q6 Q5")
def q_output_checks(spark, sf_dir):
    path = _saved(spark, sf_dir, "fitted", lambda: fitted_pipeline(spark, sf_dir))
    return finish(scoring.output_checks(scoring.load(path), features(spark, sf_dir)))


def _lin(weights: list[float], bias: float | None = None) -> str:
    terms = [] if bias is None else [f"{bias!r}e0"]
    return " + ".join(terms + [f"z_{c} * ({w!r}e0)" for c, w in zip(FC, weights)])


def _case(rules: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in rules) + f" ELSE '{default}' END"


def assessment_sql(ctes: list[str]) -> str:
    """The whole assessment in SQL over the feature table of ``ctes``."""
    dist = ", ".join("sqrt(" + " + ".join(f"(z_{c} - ({v!r}e0)) * (z_{c} - ({v!r}e0))" for c, v in zip(FC, centre))
                     + f") AS d{j}" for j, centre in enumerate(CENTRES))
    near = "least(" + ", ".join(f"d{j}" for j in range(K.KMEANS_K)) + ")"
    seg = "CASE " + " ".join(f"WHEN d{j} = {near} THEN {j}" for j in range(K.KMEANS_K)) + " END"
    tier = _case([(f"p >= {t}e0", label) for t, label in K.PROB_TIERS], K.LOW_TIER)
    return O.with_(ctes + [
        "mo AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1e0 ELSE "
                                     f"stddev_pop({c}) END AS s_{c}" for c in FC) + " FROM feat)",
        "z AS (SELECT feat.*, " + ", ".join(f"(feat.{c} - mo.m_{c}) / mo.s_{c} AS z_{c}" for c in FC)
        + " FROM feat, mo)",
        f"sc AS (SELECT z.*, 1e0 / (1e0 + exp(-({_lin(WEIGHTS, BIAS)}))) AS p, {_lin(NEXT_WEIGHTS, NEXT_BIAS)} AS nxt, "
        f"{dist}, {_lin(LOADINGS[0])} AS c1, {_lin(LOADINGS[1])} AS c2 FROM z)",
        f"seg AS (SELECT *, {tier} AS risk_level, {seg} AS segment FROM sc)"],
        "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, round(round(p, 4), 6) AS probability, risk_level, "
        "CASE risk_level " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.API_ACTIONS.items()) + " END AS action, "
        "concat_ws(', ', " + ", ".join(f"CASE WHEN {f} > 0 THEN '{t}' END" for f, t in K.ALERTS)
        + f", CASE WHEN qsofa >= 2 THEN '{K.QSOFA_ALERT}' END) AS alerts, "
        f"{O.bround_sql('nxt', 1)} AS next_hour, {O.bround_sql('nxt - hr', 1)} AS change, "
        + _case([(f"nxt > hr + {K.TREND_MARGIN}e0", "rising"), (f"nxt < hr - {K.TREND_MARGIN}e0", "falling")], "stable")
        + " AS trend, " + _case([(f"nxt > {t}e0", v) for t, v in K.HR_STATUS], K.HR_STATUS_DEFAULT) + " AS status, "
        "CAST(segment AS BIGINT) AS segment, CASE segment "
        + " ".join(f"WHEN {j} THEN '{v}'" for j, v in enumerate(K.SEGMENT_LABELS)) + " END AS segment_name, "
        + ", ".join(f"round(round(d{j}, 3), 6) AS dist_{j}" for j in range(K.KMEANS_K))
        + ", round(round(c1, 4), 6) AS pc1, round(round(c2, 4), 6) AS pc2, "
        + _case([(f"c1 > {t}e0 OR c2 > {t}e0", v) for t, v in K.ZONES], K.ZONE_DEFAULT) + " AS zone FROM seg")


@query("assessment_fixed", "J1 J16 J17 E4 E6 E7 E8 E9 E10", assessment_sql(O.FEATURE_CTES))
def q_assessment_fixed(spark, sf_dir):
    rows = features(spark, sf_dir)
    path = _saved(spark, sf_dir, "given", lambda: given_pipeline(rows))
    return finish(scoring.load(path).transform(rows).select(*OUT))


@query("stream_assessment", "ST1 ST2 J16 J17", assessment_sql(FWD_CTES))
def q_stream_assessment(spark, sf_dir):
    """Event files -> rolling features (one stream, written) -> saved pipeline (a second stream)."""
    rows = ST.event_rows(ST.events_stream(spark, events_glob(sf_dir)))
    table = ST.run_to_table(ST.rolling_features_stream(rows), spark, "stream-features")
    path = _saved(spark, sf_dir, "given-stream", lambda: given_pipeline(spark.read.parquet(table)))
    out = ST.assess_stream(spark, ST.table_stream(spark, table), path)
    return finish(out.select(*OUT))
