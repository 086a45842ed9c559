"""Exact k-NN join of all probes (J12, G5) against NumPy."""

import numpy as np
import pytest

from panelkit.operators import knn_join


def nearest(profiles, probes, k, exclude):
    """{(probe, rank): (profile, distance)} by sorting all distances."""
    out = {}
    for q, v in probes:
        d = sorted((float(np.sqrt(((np.array(v) - np.array(p)) ** 2).sum())), i) for i, p in profiles
                   if not (exclude and i == q))
        out |= {(q, r): (i, round(x, 9)) for r, (x, i) in enumerate(d[:k], 1)}
    return out


@pytest.mark.parametrize("cells,block_rows", [(None, 4096), (7, 20), (1, 4096)])
def test_join_with_a_third_of_equal_profiles(spark, cells, block_rows):
    rnd = np.random.default_rng(3)
    rows = [(f"p{i:04d}", [float(x) for x in rnd.integers(-20, 20, size=3)]) for i in range(300)]
    rows += [(f"s{i:04d}", rows[0][1]) for i in range(150)]
    prof = spark.createDataFrame([(i, *v, 1) for i, v in rows], "patient_id string, a double, b double, c double, extra int")
    got = knn_join.knn_join(prof, prof.withColumnRenamed("patient_id", "query_id"), ["a", "b", "c"], 4,
                            standardize=False, cells=cells, block_rows=block_rows).collect()
    assert {(r["query_id"], r["rank"]): (r["patient_id"], round(r["distance"], 9)) for r in got} \
        == nearest(rows, rows, 4, True)
    assert len(got) == 4 * len(rows)


def test_join_edges(spark):
    schema = "patient_id string, a double, b double"
    prof = spark.createDataFrame([("x", None, float("nan")), ("y", 0.0, 1.0), (None, 5.0, 5.0)], schema)
    probes = spark.createDataFrame([("x", 0.0, 0.0), ("q", None, 1.0), ("q", None, 1.0), (None, 0.0, 0.0)],
                                   "query_id string, a double, b double")
    def run(p, q, **how):
        return sorted((r["query_id"], r["rank"], r["patient_id"], r["distance"]) for r in knn_join.knn_join(
            p, q, ["a", "b"], 5, standardize=False, **how).collect())
    assert run(prof, probes) == [("q", 1, "y", 0.0), ("q", 2, "x", 1.0), ("x", 1, "y", 1.0)]
    assert run(prof, probes, exclude_self=False)[-2:] == [("x", 1, "x", 0.0), ("x", 2, "y", 1.0)]
    assert run(prof.limit(0), probes) == [] and run(prof, probes.limit(0)) == []


def test_cells_hand_on_no_point_beyond_the_bound():
    rnd = np.random.default_rng(5)
    q, pts = rnd.normal(size=(40, 6)), rnd.normal(size=(300, 6))
    d = knn_join._squares(q, pts)
    reach = np.sort(d, axis=1)[:, 2]
    i, j = knn_join._nearest(d, reach, 5)
    assert len(i) == 3 * 40 and all(set(j[i == a]) == set(np.argsort(d[a])[:3]) for a in range(40))
    tied = np.array([[2.0, 1.0, 1.0, 1.0, 0.5]])
    assert knn_join._nearest(tied, np.array([np.inf]), 3)[1].tolist() == [4, 1, 2]  # ties: the earlier
    cells = {"pivot": pts[:1], "radius": np.array([np.sqrt(knn_join._squares(pts, pts[:1])).max()]),
             "nearest": np.array([0.0]), "low": pts.min(axis=0)[None], "high": pts.max(axis=0)[None]}
    assert (knn_join._least_distance(q + 4, cells)[:, 0] <= np.sqrt(knn_join._squares(q + 4, pts)).min(axis=1)).all()
    assert (knn_join._least_distance(q + 9, cells) > 0).all()


def test_join_in_many_cells_equals_all_distances(spark):
    rnd = np.random.default_rng(8)
    rows = [(f"p{i:04d}", [float(x) for x in rnd.normal(size=6)]) for i in range(600)]
    names = [f"f{i}" for i in range(6)]
    prof = spark.createDataFrame([(i, *v) for i, v in rows], "patient_id string, " + ", ".join(f"{c} double" for c in names))
    got = knn_join.knn_join(prof, prof.withColumnRenamed("patient_id", "query_id"), names, 5, standardize=False,
                            cells=40, block_rows=50).collect()
    assert {(r["query_id"], r["rank"]): (r["patient_id"], round(r["distance"], 9)) for r in got} \
        == nearest(rows, rows, 5, True)
