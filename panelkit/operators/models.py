"""Model fitting as Spark ML jobs (J1-J10); ``scoring`` applies the fitted parts.

Fits are distributed Spark ML estimators over an assembled, cached training
frame. Statistics that parameterise a model (scaler moments, centres,
loadings) are a handful of numbers and are inlined as literals, so scoring
stays plain column expressions inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.config import cut_lineage


# ------------------------------------------------------------------ J1 scaler

def scaler_moments(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column in one aggregate; zero std -> 1."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
    out = {}
    for i, c in enumerate(columns):
        m, s = row[f"m_{i}"], row[f"s_{i}"]
        out[c] = (float(m) if m is not None else 0.0,
                  float(s) if s not in (None, 0.0) else 1.0)
    return out


def apply_scaler(df: DataFrame, moments: dict[str, tuple[float, float]],
                 suffix: str = "") -> DataFrame:
    repl = {c: ((F.col(c) - F.lit(m)) / F.lit(s)).alias(c + suffix) for c, (m, s) in moments.items()}
    if suffix:
        return df.select("*", *repl.values())
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def standardize(df: DataFrame, columns: list[str], fit: DataFrame | None = None,
                suffix: str = "") -> tuple[DataFrame, dict]:
    """Z-scores with population std (zero std -> 1), fit on ``fit``."""
    mom = scaler_moments(fit if fit is not None else df, columns)
    return apply_scaler(df, mom, suffix), mom


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep").transform(df)


# ------------------------------------------------------------------ rows of iterative fits

# A fit's task has FIT_ROWS rows at least, unless there are more than FIT_TASKS tasks a
# core; then up to FIT_MOST_ROWS rows.
FIT_ROWS, FIT_TASKS, FIT_MOST_ROWS = 10_000, 3, 250_000


def fit_rows(df: DataFrame) -> DataFrame:
    """All rows of ``df``, written once and gathered into as many partitions as their
    number asks for. An iterative fit is hundreds of jobs over all partitions (one a
    tree level), so many small partitions cost more than the rows in them."""
    rows = cut_lineage(df)
    n, parts = rows.count(), rows.rdd.getNumPartitions()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    few = max(1, min(-(-n // FIT_ROWS), max(FIT_TASKS * cores, -(-n // FIT_MOST_ROWS))))
    return rows.coalesce(few) if few < parts else rows


# ------------------------------------------------------------------ presets

@dataclass
class Presets:
    """Estimator settings. ``published()`` are the source pipeline's values;
    the defaults are small and for tests; the jobs and the registered queries run
    the published ones."""
    lr_max_iter: int = 25
    rf_trees: int = 10
    rf_depth: int = 6
    rf_min_leaf: int = 10
    reg_depth: int = 6
    xgb_rounds: int = 10
    xgb_depth: int = 4
    gb_rounds: int = 10
    gb_depth: int = 4
    gb_min_leaf: int = 20
    gb_subsample: float = 0.8
    reg_trees: int = 10
    reg_rounds: int = 10
    reg_partition_rows: int = 100_000
    ridge_alpha: float = 1.0
    kmeans_restarts: int = 2
    kmeans_iter: int = 10
    seed: int = 42
    extra: dict = field(default_factory=dict)

    @staticmethod
    def published() -> "Presets":
        return Presets(lr_max_iter=1000, rf_trees=100, rf_depth=20, rf_min_leaf=10,
                       # unlimited in the source, 30 at most in Spark, where 20 trees of depth 30 over 8,000
                       # rows did not end in 270 s: each level sends histograms of all nodes (README)
                       reg_depth=6,
                       xgb_rounds=200, xgb_depth=6, gb_rounds=200, gb_depth=5,
                       gb_min_leaf=20, gb_subsample=0.8, reg_trees=100, reg_rounds=100,
                       ridge_alpha=1.0, kmeans_restarts=K.KMEANS_RESTARTS, kmeans_iter=300)


# ------------------------------------------------------------------ J2-J5 classifiers

def classifiers(train: DataFrame, presets: Presets = Presets(), features: str = "features",
                label: str = "label") -> dict:
    """Fit the four classifiers; ``train`` must carry ``w_bal`` and ``w_pos`` weights.

    J2 logistic: sklearn's C=1 objective maps to regParam = 1/(C * sum(w));
    balanced weights sum to n, so regParam = 1/n.
    """
    train = fit_rows(train.select(features, label, "w_bal", "w_pos"))
    n = train.count()
    lr = LogisticRegression(featuresCol=features, labelCol=label, weightCol="w_bal",
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
                            maxIter=presets.lr_max_iter)
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, weightCol="w_bal",
                                numTrees=presets.rf_trees, maxDepth=presets.rf_depth,
                                minInstancesPerNode=presets.rf_min_leaf,
                                featureSubsetStrategy="sqrt", seed=presets.seed)
    xgb = GBTClassifier(featuresCol=features, labelCol=label, weightCol="w_pos",
                        maxIter=presets.xgb_rounds, maxDepth=presets.xgb_depth, stepSize=0.1,
                        seed=presets.seed)
    gb = GBTClassifier(featuresCol=features, labelCol=label, weightCol="w_bal",
                       maxIter=presets.gb_rounds, maxDepth=presets.gb_depth, stepSize=0.1,
                       subsamplingRate=presets.gb_subsample, minInstancesPerNode=presets.gb_min_leaf,
                       seed=presets.seed)
    return {"Logistic Regression": lr.fit(train), "Random Forest": rf.fit(train),
            "XGBoost": xgb.fit(train), "Gradient Boosting": gb.fit(train)}


def positive_probability(pred: DataFrame, name: str = "prob") -> DataFrame:
    return pred.withColumn(name, vector_to_array(F.col("probability"))[1])


# ------------------------------------------------------------------ J6-J7 regressors

def ridge(train: DataFrame, alpha: float = 1.0, features: str = "features",
          label: str = "target") -> "LinearRegression":
    """Ridge with sklearn's alpha.

    Spark's normal-equation solver standardises the label internally, which
    divides regParam by the label's std; regParam = alpha * std_y / n gives
    sklearn's objective ||y - Xw||^2 + alpha ||w||^2.
    """
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    n, s = st["n"], st["s"] or 1.0
    est = LinearRegression(featuresCol=features, labelCol=label, regParam=alpha * s / max(n, 1),
                           elasticNetParam=0.0, standardization=False, solver="normal")
    return est.fit(train)


REGRESSORS = ("Ridge Regression", "Random Forest", "XGBoost")


def regressors(train: DataFrame, presets: Presets = Presets(), features: str = "features",
               label: str = "target", names: tuple[str, ...] = REGRESSORS) -> dict:
    """Fit the regressors of ``names``. The forest takes all features at every
    node; Spark sends one dense histogram a node, feature and partition, so its
    rows are put into few partitions and its depth is bounded (README: figures)."""
    out = {}
    train = fit_rows(train.select(features, label))
    if "Ridge Regression" in names:
        out["Ridge Regression"] = ridge(train, presets.ridge_alpha, features, label)
    if "Random Forest" in names:
        few = max(1, min(train.rdd.getNumPartitions(), -(-train.count() // presets.reg_partition_rows)))
        rf = RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=presets.reg_trees,
                                   maxDepth=presets.reg_depth, featureSubsetStrategy="all",
                                   maxMemoryInMB=512, seed=presets.seed)
        out["Random Forest"] = rf.fit(train.coalesce(few))
    if "XGBoost" in names:
        gb = GBTRegressor(featuresCol=features, labelCol=label, maxIter=presets.reg_rounds,
                          maxDepth=presets.xgb_depth, stepSize=0.3, checkpointInterval=10,
                          seed=presets.seed)
        out["XGBoost"] = gb.fit(train)
    return out


def boosted_windows(train: DataFrame, presets: Presets = Presets(), features: str = "features", label: str = "y"):
    """J11(c): boosted trees over lags and window summary."""
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=presets.reg_rounds,
                        maxDepth=presets.xgb_depth, stepSize=0.3, seed=presets.seed).fit(fit_rows(train.select(features, label)))


def linear_windows(train: DataFrame, features: str = "features", label: str = "y"):
    """J11(a): ordinary least squares over lags."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="normal").fit(train)


# ------------------------------------------------------------------ J8 clustering

def kmeans_fit(rows: DataFrame, k: int = K.KMEANS_K, restarts: int = K.KMEANS_RESTARTS, max_iter: int = 300,
               seed: int = 42, features: str = "features"):
    """Best of ``restarts`` seeded k-means fits over all ``rows`` by training cost."""
    best = None
    rows = fit_rows(rows.select(features))
    for r in range(restarts):
        m = KMeans(k=k, seed=seed + r, maxIter=max_iter, featuresCol=features,
                   initMode="k-means||").fit(rows)
        cost = m.summary.trainingCost
        if best is None or cost < best[1]:
            best = (m, cost)
    return best[0]


def centre_distances(centres: list[list[float]], columns: list[str]) -> list[Column]:
    """Euclidean distance to each literal centre, as columns ``dist_<i>``."""
    out = []
    for i, c in enumerate(centres):
        sq = F.lit(0.0)
        for v, name in zip(c, columns):
            d = F.col(name) - F.lit(float(v))
            sq = sq + d * d
        out.append(F.sqrt(sq).alias(f"dist_{i}"))
    return out


def assign_nearest(df: DataFrame, centres: list[list[float]], columns: list[str],
                   name: str = "cluster") -> DataFrame:
    """J8 assign: argmin distance over literal centres, ties to the lowest id."""
    with_d = df.select("*", *centre_distances(centres, columns))
    structs = [F.struct(F.col(f"dist_{i}").alias("d"), F.lit(i).alias("id")) for i in range(len(centres))]
    return with_d.withColumn(name, F.least(*structs)["id"])


def segment_labels(profile: DataFrame, segment: str = "cluster", rate: str = "sepsis_rate") -> DataFrame:
    """Segments ranked by ascending outcome rate (ties by id) get labels.

    The input is one row per segment (k rows), so the global ordering is on
    an aggregated table only."""
    from pyspark.sql import Window
    rank = F.row_number().over(Window.orderBy(F.col(rate), F.col(segment))) - 1
    labels = F.array(*[F.lit(x) for x in K.SEGMENT_LABELS])
    return profile.select(segment, rate, F.element_at(labels, (rank + 1).cast("int")).alias("risk_label"))


# ------------------------------------------------------------------ J10 PCA

@dataclass
class PcaResult:
    loadings: np.ndarray            # components x features, signs fixed
    explained: np.ndarray           # explained variance ratio per component
    cumulative: np.ndarray


def pca_fit(df: DataFrame, columns: list[str], k: int | None = None,
            features: str = "features") -> PcaResult:
    """PCA of standardised columns with Spark ML (distributed Gramian).

    Spark's ``PCAModel.transform`` does not centre, so input must be centred
    (standardised). Signs are fixed so the largest-|loading| entry is positive.
    """
    k = k or len(columns)
    model = PCA(k=k, inputCol=features, outputCol="pca").fit(assemble(df, columns, features))
    pc = np.array(model.pc.toArray().T, copy=True)  # k x d
    for i in range(pc.shape[0]):
        j = int(np.argmax(np.abs(pc[i])))
        if pc[i, j] < 0:
            pc[i] = -pc[i]
    ev = np.array(model.explainedVariance.toArray())
    return PcaResult(pc, ev, np.cumsum(ev))


def components_for(cumulative: np.ndarray, threshold: float) -> int:
    """count(cumulative < t) + 1."""
    return int((cumulative < threshold).sum() + 1)


def project(df: DataFrame, loadings: np.ndarray, columns: list[str], prefix: str = "pc") -> DataFrame:
    """Project (already centred) columns on literal loadings: pc1, pc2, ..."""
    cols = []
    for i, row in enumerate(loadings):
        e = F.lit(0.0)
        for v, c in zip(row, columns):
            e = e + F.col(c) * F.lit(float(v))
        cols.append(e.alias(f"{prefix}{i + 1}"))
    return df.select("*", *cols)


def top_loadings(result: PcaResult, columns: list[str], spark, top: int = 5) -> DataFrame:
    """H4: top features by |loading| per component (melted, row_number)."""
    from pyspark.sql import Window
    rows = [(f"PC{i + 1}", columns[j], float(result.loadings[i, j]))
            for i in range(result.loadings.shape[0]) for j in range(len(columns))]
    melted = spark.createDataFrame(rows, "component string, feature string, loading double")
    w = Window.partitionBy("component").orderBy(F.abs("loading").desc(), F.col("feature"))
    return (melted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top))
