"""Embedding near-dedup: spherical k-means cells, blocked cosine products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import connected_components, lookup, map_arrow, merge_links, table

MIN_COS = 0.98
# All centroids together take at most this many bytes (broadcast); the k-means
# sample has at most SAMPLE_PER_CELL vectors a cell.
CENTROID_BYTES = 32 << 20
SAMPLE_PER_CELL = 24
ROUNDS = 6
# Labels with fewer vectors are one cell.
LABEL_ROWS = 1024
# Rows of one side of a comparison block.
BLOCK_ROWS = 2048


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision (no overflow on the way)."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def fit_cells(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means centroids of unit rows ``x`` (first k rows start)."""
    c = x[:k].copy()
    for _ in range(rounds):
        at = np.argmax(x @ c.T, axis=1)
        for i in range(len(c)):
            s = x[at == i].sum(axis=0)
            n = np.sqrt(s @ s)
            if n > 1e-12:
                c[i] = s / n
    return c


def cells_of(x: np.ndarray, c: np.ndarray, min_cos: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell of each row, rows x cells: may the cell be home to a partner).

    y is at home in c' only on that side of the hyperplane between x's centroid c
    and c'; a unit x at distance h = x.(c - c')/|c - c'| from the plane and y
    beyond it enclose an angle of at least asin(h). So x meets a partner with
    cos >= min_cos only in cells with h <= sin(acos(min_cos)): no link is lost."""
    s = x @ c.T
    home = np.argmax(s, axis=1)
    gap = np.sqrt(np.maximum(2 - 2 * np.clip(c @ c.T, -1, 1), 0))[home]
    reach = np.sqrt(max(0.0, 1 - min_cos * min_cos))
    visit = s[np.arange(len(x)), home][:, None] - s <= reach * gap + 1e-9
    visit[np.arange(len(x)), home] = True
    return home, visit


def _points(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, point, label, vec): point is null for what links with nothing."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    usable = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & finite
              & F.exists(v, lambda e: e != 0))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
                          v.alias("vec"), F.coalesce(usable, F.lit(False)).alias("usable"))
    # + 0 makes -0.0 and 0.0 one value
    vec = F.transform("vec", lambda e: e + F.lit(0).cast(rows.schema["vec"].dataType.elementType))
    return rows.select("id", F.when(F.col("usable"), F.xxhash64("label", vec)).alias("point"), "label", vec.alias("vec"))


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", min_cos: float = MIN_COS, block_rows: int = BLOCK_ROWS,
                    label_rows: int = LABEL_ROWS) -> DataFrame:
    """One row per row of ``vectors``: id_col, n_links, component_id, kept.

    Vectors with equal labels link at cosine >= min_cos (double precision).
    Null, zero, empty or not finite vectors, null labels and null identifiers
    link with nothing (n_links 0, component_id their own identifier, kept).
    Vectors of different lengths do not link. Copies are one point with a
    weight, and each copy is a link of the others; so are repeated rows. Ties
    at exactly min_cos link. Empty table: empty result. Copies and large cells
    never meet in one task: cells are compared in blocks of ``block_rows``.
    """
    spark = vectors.sparkSession
    rows = _points(vectors, id_col, vec_col, label_col)
    points = cut_lineage(rows.filter("point is not null").groupBy("point").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.min("id").alias("id"),
        F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("vec")))
    stats = points.agg(F.count(F.lit(1)), F.max("dim"), F.sum("n")).first()
    n_points, dim, total = stats[0], stats[1] or 1, stats[2] or 0

    # Cells: sqrt(n)/4 for each label of enough vectors. Such labels hold at
    # least n_points/max_cells vectors each, so there are at most max_cells.
    max_cells = max(64, CENTROID_BYTES // (8 * dim))
    least = max(label_rows, -(-n_points // max_cells))
    labels = (points.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= least)
              .withColumn("k", F.ceil(F.sqrt("m") / 4)).limit(max_cells))
    wish = labels.agg(F.sum("k")).first()[0] or 0
    share = min(1.0, max_cells / max(wish, 1))
    labels = cut_lineage(labels.withColumn("k", F.greatest(F.lit(1), F.floor(F.col("k") * share)).cast("int")))
    pick = F.pmod(F.xxhash64(F.lit(17), "point"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (points.join(F.broadcast(labels), ["label", "dim"])
              .filter(pick < F.col("k") * SAMPLE_PER_CELL / F.col("m")).select("label", "dim", "k", "point", "vec"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("point")
        x = unit(np.array(group["vec"].tolist()))
        c = fit_cells(x, min(int(group["k"].iloc[0]), len(x)))
        return pd.DataFrame({"label": group["label"].iloc[0], "dim": group["dim"].iloc[0],
                             "cell": np.arange(len(c)), "c": list(c)})

    fitted: dict[tuple[str, int], np.ndarray] = {}
    for r in (sample.groupBy("label", "dim").applyInPandas(fit, "label string, dim int, cell int, c array<double>")
              .orderBy("label", "dim", "cell").collect()):  # at most CENTROID_BYTES
        fitted.setdefault((r["label"], r["dim"]), []).append(r["c"])
    fitted = {k: np.array(v) for k, v in fitted.items()}
    shared = spark.sparkContext.broadcast(fitted)
    code = "<f4" if rows.schema["vec"].dataType.elementType.simpleString() == "float" else "<f8"

    def grouped(b: pa.RecordBatch):
        """(label, dim, row positions, raw vectors, home, visit) by label."""
        names, dims = b.column("label").to_pylist(), b.column("dim").to_numpy()
        flat, offsets = b.column("vec").values.to_numpy(zero_copy_only=False), b.column("vec").offsets.to_numpy()
        by: dict[tuple[str, int], list[int]] = {}
        for i, key in enumerate(zip(names, dims.tolist(), strict=True)):
            by.setdefault(key, []).append(i)
        for (label, d), at in by.items():
            raw = np.stack([flat[offsets[i]:offsets[i] + d] for i in at]).astype(code)
            c = shared.value.get((label, d))
            if c is None:
                yield label, d, at, raw, np.zeros(len(at), dtype=np.int64), np.ones((len(at), 1), dtype=bool)
            else:
                yield label, d, at, raw, *cells_of(unit(raw), c, min_cos)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for label, d, _, _, home, visit in grouped(b):
                if (label, d) in shared.value:
                    k = visit.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * k), pa.array([d] * k, pa.int32()), pa.array(np.arange(k, dtype=np.int32)),
                         pa.array(np.bincount(home, minlength=k).astype(np.int64)),
                         pa.array(visit.sum(axis=0).astype(np.int64))], ["label", "dim", "cell", "homes", "visits"])

    slim = points.select("point", "label", "dim", "vec", "n")
    sizes = {}
    if fitted:
        for r in (map_arrow(slim, count, "label string, dim int, cell int, homes bigint, visits bigint")
                  .groupBy("label", "dim", "cell").agg(F.sum("homes").alias("h"), F.sum("visits").alias("v")).collect()):
            sizes[(r["label"], r["dim"], r["cell"])] = (-(-r["h"] // block_rows) or 1, -(-r["v"] // block_rows) or 1)
    blocks = spark.sparkContext.broadcast(sizes)  # at most one entry a centroid

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Home rows once for every chunk of visitors of their cell, visiting rows
        once for every block of homes of each cell they visit."""
        for b in it:
            ids, weights = b.column("point").to_numpy(), b.column("n").to_numpy()
            for label, d, at, raw, home, visit in grouped(b):
                own = ids[at]
                spread = (own.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)
                for cell in range(visit.shape[1]):
                    nb, nc = blocks.value.get((label, d, cell), (1, 1))
                    for is_home, who, mine, others in ((True, np.flatnonzero(home == cell), nb, nc),
                                                       (False, np.flatnonzero(visit[:, cell]), nc, nb)):
                        if not len(who):
                            continue
                        part = (spread[who] % np.uint64(mine)).astype(np.int32)
                        who2, part2 = np.repeat(who, others), np.repeat(part, others)
                        other = np.tile(np.arange(others, dtype=np.int32), len(who))
                        m = len(who2)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([label] * m), pa.array([d] * m, pa.int32()), pa.array([cell] * m, pa.int32()),
                             pa.array(part2 if is_home else other), pa.array(other if is_home else part2),
                             pa.array([is_home] * m), pa.array(own[who2]), pa.array(weights[at][who2]),
                             pa.array([raw[i].tobytes() for i in who2], pa.binary())],
                            ["label", "dim", "cell", "block", "chunk", "home", "point", "n", "raw"])

    dealt = map_arrow(slim, deal, "label string, dim int, cell int, block int, chunk int, home boolean, "
                                  "point bigint, n bigint, raw binary")

    def compare(t: pa.Table) -> pa.Table:
        home = t.column("home").to_numpy()
        ids, weight = t.column("point").to_numpy(), t.column("n").to_numpy()
        raw = np.frombuffer(b"".join(t.column("raw").to_pylist()), dtype=code).reshape(len(ids), -1)
        x = unit(raw)
        h, p = np.flatnonzero(home), np.flatnonzero(~home)
        both, at = np.unique(ids, return_inverse=True)
        parent, linked = np.arange(len(both)), np.zeros(len(p), dtype=np.int64)
        for a in range(0, len(p), 512):
            s = x[p[a:a + 512]] @ x[h].T
            near = s >= min_cos
            for i, j in zip(*np.nonzero(np.abs(s - min_cos) < 1e-9), strict=True):  # decided by the plain formula
                u, v = raw[p[a + i]].astype(np.float64), raw[h[j]].astype(np.float64)
                near[i, j] = (u @ v) / np.sqrt((u @ u) * (v @ v)) >= min_cos
            near &= ids[p[a:a + 512]][:, None] != ids[h][None, :]
            linked[a:a + 512] = near @ weight[h]
            i, j = np.nonzero(near)
            parent = merge_links(parent, at[p[a + i]], at[h[j]])
        child = np.flatnonzero(parent != np.arange(len(both)))
        some = np.flatnonzero(linked)
        return pa.table({"u": np.concatenate([both[child], ids[p[some]]]),
                         "v": np.concatenate([both[parent[child]], ids[p[some]]]),
                         "links": np.concatenate([np.zeros(len(child), np.int64), linked[some]])})

    found = cut_lineage(dealt.groupBy("label", "dim", "cell", "block", "chunk")
                        .applyInArrow(compare, "u bigint, v bigint, links bigint"))
    comp = connected_components(found.select("u", "v"))
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    named = (points.select("point", "id", "n").join(comp, F.col("point") == F.col("node"), "left")
             .join(counts, F.col("point") == F.col("u"), "left")
             .select("point", "id", "n", F.coalesce("component", "point").alias("component"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    best = named.groupBy("component").agg(F.min("id").alias("component_id"))
    answer = cut_lineage(named.join(best, "component").select("point", "n", "n_links", "component_id"))
    out = lookup(rows.select("id", "point"), answer, ["point"], "n", total)
    own = F.when(F.col("point").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))


def op7(spark, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.ok AND b.ok AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.a AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, c.a = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.a = c.a
"""
