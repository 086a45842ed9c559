"""Limits that must be told, not passed over: unmet targets (operator 8), too many ids (operator 9)."""

import base64

import numpy as np
import pytest

from panelkit.llm import bpe, mixing


def members(spark, p, n):
    return spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)],
                                 "n_tokens long, p array<double>").coalesce(1).cache()


def test_unmet_targets_warn_and_rounds_equal_numpy(spark):
    """Targets outside what the rows can mix: the distributed rounds equal the same rounds in NumPy, and a
    warning tells what is left. (200 rounds of them end at squares of 0.01158; the least are 0.01109.)"""
    rnd = np.random.default_rng(8)
    p, n = rnd.dirichlet([4, 4], size=60), rnd.integers(10, 400, 60)
    want = np.array([0.0, 1.0]) * n.sum()
    with pytest.warns(UserWarning, match="between a domain and its target"):
        got = mixing.fit_rates(members(spark, p, n), want, rounds=12)
    pulls = []
    for _ in range(12):
        look = mixing.rates_of(p, pulls)[1]
        pulls = [*pulls, ((look * n) @ p - want) / n.sum()]
    assert np.allclose(got, pulls, rtol=0, atol=1e-9)
    assert mixing.rates_of(p, got)[0].min() >= 0


def test_ids_beyond_the_packing_are_refused():
    ranks = b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256))
    bpe.BytePairCodec(ranks, r".")
    beyond = ranks + b"\n" + base64.b64encode(b"ab") + b" %d" % bpe.MAX_IDS
    with pytest.raises(ValueError, match="ids must be below"):
        bpe.BytePairCodec(beyond, r".")
