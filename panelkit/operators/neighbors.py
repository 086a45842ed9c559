"""Nearest-neighbour look-alikes (J12) and the neighbour outcome vote.

Exact k-NN of a bounded query set against every profile, without a join.
The query set is size-checked (at most ``MAX_QUERIES`` rows) and travels
with the plan; profiles are never collected. Two equivalent kernels:

* up to ``INLINE_TERMS`` query-coordinate terms (queries x features): each
  query is a literal point and every profile computes its squared distance
  to each in one JVM projection;
* more queries: ``mapInPandas`` scores each Arrow batch of profiles against
  the query matrix in NumPy and emits only each query's batch top-k
  (ties at the k-th distance included).

Either way ``row_number() <= k`` per query then runs on a candidate set of
at most k rows per query per task (a partial WindowGroupLimit before the
shuffle for the first kernel), so no query's group holds all profiles.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelkit import constants as K
from panelkit.functions import scalar as X
from panelkit.operators.models import apply_scaler, scaler_moments

MAX_QUERIES = 100_000
INLINE_TERMS = 256
QUERY_BLOCK = 1024


def _inline_candidates(z: DataFrame, q_rows, qz, features, query_key) -> DataFrame:
    dists = []
    for r, zq in zip(q_rows, qz):
        sq = F.lit(0.0)
        for c, qv in zip(features, zq):
            d = F.col(c + "_z") - F.lit(float(qv))
            sq = sq + d * d
        dists.append(F.struct(F.lit(r[query_key]).alias(query_key), sq.alias("d2")))
    return z.select("*", F.explode(F.array(*dists)).alias("_q")).select("*", "_q.*").drop("_q")


def _batch_candidates(z: DataFrame, q_ids, qz, features, query_key, profile_key, k,
                      exclude_self) -> DataFrame:
    """Per Arrow batch: distances to every query, keep each query's top-k."""
    zcols = [c + "_z" for c in features]
    keep = [c for c in z.columns if c not in zcols]
    out_schema = StructType([f for f in z.schema.fields if f.name in keep]
                            + [StructField(query_key, StringType()), StructField("d2", DoubleType())])
    P = np.asarray(qz, dtype="float64")            # queries x features
    ids = np.asarray([str(q) for q in q_ids], dtype=object)

    def kernel(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            Z = pdf[zcols].to_numpy(dtype="float64")
            keys = pdf[profile_key].astype(str).to_numpy()
            kk = min(k, len(pdf))
            for lo in range(0, len(ids), QUERY_BLOCK):       # bounded batch x block matrix
                Pb, idb = P[lo:lo + QUERY_BLOCK], ids[lo:lo + QUERY_BLOCK]
                D = np.zeros((len(pdf), len(idb)))
                for j in range(Pb.shape[1]):               # same summation order as the JVM kernel
                    t = Z[:, j, None] - Pb[None, :, j]
                    D = D + t * t
                if exclude_self:
                    D[keys[:, None] == idb[None, :]] = np.inf
                kth = np.partition(D, kk - 1, axis=0)[kk - 1]          # per query
                rows, cols = np.nonzero((D <= kth[None, :]) & np.isfinite(D))
                part = pdf.iloc[rows][keep].reset_index(drop=True)
                part[query_key] = idb[cols]
                part["d2"] = D[rows, cols]
                yield part

    return z.mapInPandas(kernel, out_schema)


def knn(profiles: DataFrame, queries: DataFrame, features: list[str], k: int = K.KNN_K,
        profile_key: str = "patient_id", query_key: str = "query_id",
        exclude_self: bool = True, standardize: bool = True) -> DataFrame:
    """The k nearest profiles of every query (Euclidean, standardised).

    Features are null-filled with 0 and z-scored with the profiles' mean and
    population std (zero std -> 1). A query whose key equals a profile key
    never matches itself (self is excluded by key, not by position). Ties in
    distance are broken by the profile key.
    Output: query key, rank (1..k), profile key, distance, plus profile columns.
    """
    q_rows = queries.select(query_key, *features).limit(MAX_QUERIES + 1).collect()
    if len(q_rows) > MAX_QUERIES:
        raise ValueError(f"query set larger than {MAX_QUERIES} rows; split it into bounded batches")
    if not q_rows:
        return profiles.sparkSession.createDataFrame(
            [], f"{query_key} string, rank int, {profile_key} string, distance double")
    prof = profiles.na.fill(0.0, subset=features)
    mom = scaler_moments(prof, features) if standardize else {c: (0.0, 1.0) for c in features}
    z = apply_scaler(prof, mom, suffix="_z")
    qz = [[(float(r[c] or 0.0) - mom[c][0]) / mom[c][1] for c in features] for r in q_rows]
    if len(q_rows) * len(features) <= INLINE_TERMS:
        cand = _inline_candidates(z, q_rows, qz, features, query_key)
        if exclude_self:
            cand = cand.filter(F.col(query_key).cast("string") != F.col(profile_key).cast("string"))
    else:
        cand = _batch_candidates(z, [r[query_key] for r in q_rows], qz, features, query_key,
                                 profile_key, k, exclude_self)
    w = Window.partitionBy(query_key).orderBy(F.col("d2"), F.col(profile_key))
    top = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.withColumn("distance", F.sqrt("d2")).drop("d2", *[c + "_z" for c in features])


def neighbour_vote(neigh: DataFrame, query_key: str = "query_id", outcome: str = "had_sepsis",
                   stay: str = "total_icu_hours") -> DataFrame:
    """Positives among the neighbours, risk percent, mean stay, tier, advice."""
    v = neigh.groupBy(query_key).agg(
        F.sum(F.col(outcome)).cast("long").alias("sepsis_count"),
        F.count(F.lit(1)).alias("neighbours"),
        F.avg(stay).alias("avg_icu_hours"))
    pct = F.bround(F.col("sepsis_count") / F.greatest(F.col("neighbours"), F.lit(1)) * 100.0, 0).cast("long")
    tier = X.vote_tier("sepsis_count")
    rec = X.lookup(tier, {k: v[0] for k, v in K.JOB_ACTIONS.items()})
    act = X.lookup(tier, {k: v[1] for k, v in K.JOB_ACTIONS.items()})
    return v.select(query_key, "sepsis_count", "neighbours", pct.alias("risk_pct"), "avg_icu_hours",
                    tier.alias("risk_level"), rec.alias("recommendation"), act.alias("action"),
                    X.api_action(tier).alias("api_action"))


def describe_neighbours(neigh: DataFrame) -> DataFrame:
    """Similarity percent and outcome label per neighbour."""
    return neigh.withColumn("similarity", X.similarity_pct("distance")) \
                .withColumn("outcome", X.outcome_label("had_sepsis"))
