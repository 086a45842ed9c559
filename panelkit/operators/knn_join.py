"""Exact k-NN join of probes and profiles of any number (J12, G5): pivot cells
with radius bounds, bounded tasks, no cross join.

Equal vectors are one point. Every profile point goes to the cell of its nearest
pivot. A probe first meets the few cells nearest to it, which gives a bound on its
k-th distance; then it visits those cells only whose ring around the pivot and whose
box (least and largest coordinates) come within the bound. Cells and their visitors
meet in blocks, each of which hands on at most k points a probe, none beyond the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.config import cut_lineage
from panelkit.operators.models import scaler_moments

# Pivots (collected, at most MAX_CELLS vectors) and rows of one side of a block.
MAX_CELLS = 2048
BLOCK_ROWS = 4096
# Points of a cell, unless there are too many cells, and cells a probe meets first.
CELL_POINTS = 128
FIRST_CELLS = 4
# Distances are compared with bounds up to the rounding of their sums.
SLACK = 1e-9


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``, added in column order."""
    d = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        t = a[:, j, None] - b[None, :, j]
        d += t * t
    return d


def _z(df: DataFrame, features: list[str], moments: dict, key: str, name: str) -> DataFrame:
    vec = F.array(*[(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) - F.lit(moments[c][0]))
                    / F.lit(moments[c][1]) + F.lit(0.0) for c in features])
    return df.select(F.col(key).cast("string").alias(name), vec.alias("v"))


def _to_cells(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``points(v)`` with the cell of the nearest pivot and the distance to it."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), BLOCK_ROWS):
                part = pdf.iloc[lo:lo + BLOCK_ROWS]
                d = _squares(np.stack(part["v"].to_numpy()), shared.value)
                cell = d.argmin(axis=1)
                yield part.assign(cell=cell.astype("int32"), away=np.sqrt(d[np.arange(len(part)), cell]))
    return points.mapInPandas(task, ", ".join(f"{n} {t}" for n, t in points.dtypes) + ", cell int, away double")


def _least_distance(q: np.ndarray, cells: dict[str, np.ndarray]) -> np.ndarray:
    """For every row of ``q`` and cell, a distance that none of the cell's points undercuts
    (infinite for cells without points): by its ring around the pivot and by its box."""
    box = np.zeros((len(q), len(cells["pivot"])))
    for j in range(q.shape[1]):
        t = np.maximum(np.maximum(cells["low"][None, :, j] - q[:, j, None], q[:, j, None] - cells["high"][None, :, j]), 0.0)
        box += t * t
    away = np.sqrt(_squares(q, cells["pivot"]))
    ring = np.maximum(away - cells["radius"], cells["nearest"] - away)
    return np.maximum(np.maximum(ring, np.sqrt(box)) - SLACK * (1 + away), 0.0)


def _nearest(d: np.ndarray, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k least entries of every row of ``d`` that are within the
    row's ``reach``; ties: the earlier column."""
    k = min(k, d.shape[1])
    limit = np.minimum(np.partition(d, k - 1, axis=1)[:, k - 1], reach)
    i, j = np.nonzero(d <= limit[:, None])
    order = np.lexsort((j, d[i, j], i))
    i, j = i[order], j[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep]


def _meet(points: DataFrame, visits: DataFrame, sizes: dict[int, int], k: int, block_rows: int) -> DataFrame:
    """(qn, least, d2): of every block of a cell, the k points nearest to each visitor, as
    far as they are within its reach.

    ``points(v, least, cell)``, ``visits(qn, qv, reach, cell)`` with squared distances as
    reach; ``sizes``: points of every cell."""
    counts = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def pieces(n: dict[int, int]) -> F.Column:
        many = {c: -(-x // block_rows) for c, x in n.items() if x > block_rows}
        if not many:
            return F.lit(1)
        entries = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
        return F.coalesce(F.element_at(entries, F.col("cell")), F.lit(1))

    def dealt(df: DataFrame, own: str, mine: dict, other: dict, vec: str) -> DataFrame:
        own_piece = F.pmod(F.xxhash64(vec), pieces(mine).cast("bigint")).cast("int")
        return df.withColumn("mine", own_piece).withColumn(
            "other", F.explode(F.sequence(F.lit(0), (pieces(other) - 1).cast("int"))))

    home = dealt(points, "v", sizes, counts, "v").select(
        "cell", F.col("mine").alias("block"), F.col("other").alias("chunk"), "v", "least",
        F.lit(None).cast("long").alias("qn"), F.lit(None).cast("double").alias("reach"))
    guests = dealt(visits, "qv", counts, sizes, "qv").select(
        "cell", F.col("other").alias("block"), F.col("mine").alias("chunk"), F.col("qv").alias("v"),
        F.lit(None).cast("string").alias("least"), "qn", "reach")

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        own, probes = pdf[pdf["qn"].isna()].sort_values("least"), pdf[pdf["qn"].notna()]
        out = []
        if len(own) and len(probes):
            pv, names = np.stack(own["v"].to_numpy()), own["least"].to_numpy()
            qn, reach = probes["qn"].to_numpy(dtype="int64"), probes["reach"].to_numpy(dtype="float64")
            for lo in range(0, len(probes), 512):
                d = _squares(np.stack(probes["v"].to_numpy()[lo:lo + 512]), pv)
                i, j = _nearest(d, reach[lo:lo + 512], k)
                out.append(pd.DataFrame({"qn": qn[lo + i], "least": names[j], "d2": d[i, j]}))
        if not out:
            return pd.DataFrame({"qn": pd.Series(dtype="int64"), "least": pd.Series(dtype=object),
                                 "d2": pd.Series(dtype=float)})
        return pd.concat(out, ignore_index=True)

    return home.unionByName(guests).groupBy("cell", "block", "chunk").applyInPandas(
        kernel, "qn long, least string, d2 double")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qn").orderBy("d2", "least")
    return found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)


def knn_join(profiles: DataFrame, probes: DataFrame, features: list[str], k: int = K.KNN_K,
             profile_key: str = "patient_id", query_key: str = "query_id", exclude_self: bool = True,
             standardize: bool = True, cells: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_key, rank, profile_key, distance): the k nearest profiles of every probe.

    Exact, for any number of probes and profiles. Nulls and NaN count as 0; features
    are z-scored with the profiles' mean and population std unless ``standardize``
    is off. Keys are compared as strings: a probe never matches the profile of its
    own key, and ties in distance go to the smaller key. Probes of a repeated key
    are one if their features are equal, else each has its own neighbours. Rows of
    null keys are left out. Fewer than k profiles: all of them. Either side empty:
    empty result.
    """
    keyed = profiles.filter(F.col(profile_key).isNotNull())
    mom = scaler_moments(keyed.na.fill(0.0, subset=features), features) if standardize else {c: (0.0, 1.0) for c in features}
    prof = _z(keyed, features, mom, profile_key, "pid").distinct()
    asked = cut_lineage(_z(probes.filter(F.col(query_key).isNotNull()), features, mom, query_key, "qid").distinct())
    need = k + int(exclude_self)
    # of equal vectors at most k + 1 profiles can be neighbours
    first = Window.partitionBy("v").orderBy("pid")
    copies = cut_lineage(prof.withColumn("r", F.row_number().over(first))
                         .withColumn("least", F.first("pid").over(first)).filter(F.col("r") <= need))
    points = copies.filter(F.col("r") == 1).select("v", "least")
    n = points.count()
    m = min(MAX_CELLS, cells or max(1, int(np.sqrt(n)), n // CELL_POINTS))
    pivots = np.array([r["v"] for r in points.orderBy(F.xxhash64("v"), "v").limit(m).collect()], dtype=float)
    pivots = pivots.reshape(-1, len(features))
    schema = asked.sparkSession.createDataFrame([], f"{query_key} string, rank int, {profile_key} string, distance double")
    if not len(pivots):
        return schema
    placed = cut_lineage(_to_cells(points, pivots))
    dims = range(len(features))
    bounds = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.min("away").alias("nearest"),
        F.array(*[F.min(F.col("v")[i]) for i in dims]).alias("low"),
        F.array(*[F.max(F.col("v")[i]) for i in dims]).alias("high")).collect()  # one row a pivot
    sizes = {r["cell"]: r["n"] for r in bounds}
    about = {"pivot": pivots, "radius": np.full(len(pivots), -np.inf), "nearest": np.full(len(pivots), np.inf),
             "low": np.full(pivots.shape, np.inf), "high": np.full(pivots.shape, -np.inf)}
    for r in bounds:
        for name in ("radius", "nearest", "low", "high"):
            about[name][r["cell"]] = r[name]
    shared = asked.sparkSession.sparkContext.broadcast(about)

    def first_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cells that may lie nearest."""
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo:lo + 512]
                q = np.stack(part["qv"].to_numpy())
                low = _least_distance(q, shared.value) + SLACK * _squares(q, shared.value["pivot"])
                yield part.assign(cells=list(np.argsort(low, axis=1, kind="stable")[:, :FIRST_CELLS].astype("int32")))

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The other cells that may hold one of the k nearest."""
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo:lo + 512]
                vecs, reach = part["qv"].to_numpy(), part["reach"].to_numpy(dtype="float64")
                low = _least_distance(np.stack(vecs), shared.value)
                visit = (low <= np.sqrt(reach)[:, None]) & np.isfinite(low)
                np.put_along_axis(visit, np.stack(part["cells"].to_numpy()).astype("int64"), False, axis=1)
                i, c = np.nonzero(visit)
                yield pd.DataFrame({"qn": part["qn"].to_numpy()[i], "qv": pd.Series(list(vecs[i]), dtype=object),
                                    "reach": reach[i], "cell": c.astype("int32")})

    questions = cut_lineage(asked.select(F.col("v").alias("qv")).distinct()
                            .withColumn("qn", F.monotonically_increasing_id()).select("qn", "qv")
                            .mapInPandas(first_cells, "qn long, qv array<double>, cells array<int>"))
    anywhere = F.lit(float("inf")).alias("reach")
    near = cut_lineage(_best(_meet(placed.drop("away"), questions.select("qn", "qv", anywhere,
                                                                         F.explode("cells").alias("cell")),
                                   sizes, need, block_rows), need))
    bound = near.groupBy("qn").agg(F.when(F.count(F.lit(1)) >= need, F.max("d2")).alias("reach"))
    visits = cut_lineage(questions.join(bound, "qn", "left")
                         .select("qn", "qv", F.coalesce("reach", F.lit(float("inf"))).alias("reach"), "cells")
                         .mapInPandas(further, "qn long, qv array<double>, reach double, cell int"))
    more = _meet(placed.drop("away"), visits, sizes, need, block_rows)
    best = _best(near.drop("r").unionByName(more), need).drop("r")
    named = best.join(copies.select("least", "pid"), "least").select("qn", "d2", "pid")
    top = Window.partitionBy("qn").orderBy("d2", "pid")
    named = named.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= need).drop("r")
    pairs = asked.join(questions.select("qn", "qv"), asked["v"] == F.col("qv")).join(named, "qn")
    if exclude_self:
        pairs = pairs.filter(F.col("qid") != F.col("pid"))
    w = Window.partitionBy("qid", "qn").orderBy("d2", "pid")
    return (pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("qid").alias(query_key), "rank", F.col("pid").alias(profile_key),
                    F.sqrt("d2").alias("distance")))
