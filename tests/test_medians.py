"""Exact medians by narrowing against NumPy, with small limits so that every group is a large one."""

import numpy as np
import pandas as pd
import pytest

from panelkit.operators.medians import medians


def cases():
    rng = np.random.default_rng(5)
    return {
        "odd": rng.normal(size=301), "even": rng.lognormal(0, 20, size=400), "one": np.array([3.5]),
        "two": np.array([-1e300, 1e300]), "equal": np.full(250, 7.0), "two heavy": np.r_[[1.0] * 150, [2.0] * 150],
        "heavy with few between": np.r_[[0.0] * 200, rng.uniform(0, 1, 9), [1.0] * 200],
        "negative": -rng.exponential(size=333), "subnormal": rng.integers(0, 50, 281) * 5e-324,
        "hot": np.round(rng.normal(size=3000), 2), "infinite": np.r_[[-np.inf] * 3, rng.normal(size=90), [np.inf] * 4],
    }


@pytest.mark.parametrize("limit,grid", [(0, 10), (260, 100), (10_000, 1000)])
def test_medians_match_numpy(spark, limit, grid):
    rows = [(g, float(v), None) for g, vals in cases().items() for v in vals] + [("none", None, None), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    got = {r["g"]: r for r in medians(df, ["x", "y"], ["g"], limit, grid).collect()}
    assert set(got) == set(cases())
    for g, vals in cases().items():
        assert got[g]["_med_x"] == np.median(vals), g
        assert got[g]["_med_y"] is None
    whole = medians(df, ["x", "y"], [], limit, grid).first()
    assert whole["_med_x"] == np.median(np.r_[np.concatenate(list(cases().values())), [1.0]])
    assert whole["_med_y"] == 2.0
    assert medians(df.limit(0), ["x"], [], limit, grid).first()["_med_x"] is None
    assert medians(df.limit(0), ["x"], ["g"], limit, grid).count() == 0


def test_large_groups_keep_only_the_sketch(spark):
    """A table of distinct values: beyond the limit no plan holds ``percentile``'s buffer of them."""
    df = spark.range(0, 400_000, 1, 8).selectExpr("'a' AS g", "sqrt(id * 7919 % 400000) AS x")
    want = float(np.median(np.sqrt(np.arange(400_000.0))))
    assert medians(df, ["x"], ["g"], limit=1000).first()["_med_x"] == pytest.approx(want, abs=0, rel=1e-15)
