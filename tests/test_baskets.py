"""Itemsets by conditional trees: against brute force, edges, long baskets."""

from collections import Counter
from itertools import combinations

import numpy as np

from panelkit.operators import mining


def frame(spark, baskets):
    return spark.createDataFrame([(b,) for b in baskets], "items array<string>")


def brute(baskets, support, max_len):
    c = Counter(s for b in baskets for k in range(1, max_len + 1)
                for s in combinations(sorted({x for x in b or [] if x is not None}), k))
    return {s: n / len(baskets) for s, n in c.items() if n / len(baskets) >= support}


def got(df):
    rows = df.collect()
    assert all(r["size"] == len(r["itemset"]) and r["key"] == ", ".join(r["itemset"]) for r in rows)
    out = {tuple(r["itemset"]): r["support"] for r in rows}
    assert len(out) == len(rows)
    return out


def test_tree_itemsets_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    baskets = [[f"i{x}" for x in rng.integers(0, 25, rng.integers(0, 9))] for _ in range(300)]   # repeats, empties
    baskets += [None, [], ["i1", None, "i2"], ["a, b"], ["a", "b"]]
    df = frame(spark, baskets)
    for support, max_len in [(0.01, 3), (0.05, 2), (1 / 305, 3)]:
        assert got(mining.frequent_itemsets_tree(df, "items", support, max_len)) == brute(baskets, support, max_len)
    clean = df.selectExpr("array_distinct(array_compact(coalesce(items, array()))) AS items")
    assert got(mining.frequent_itemsets_tree(clean, "items", 0.02)) == got(mining.frequent_itemsets(clean, "items", 0.02))


def test_long_baskets_and_empty_table(spark):
    """Baskets of 1,000 items (1.7e8 subsets each of up to three) that share few items."""
    baskets = [[f"b{i}_{j}" for j in range(998)] + ["x", "y"] for i in range(20)] + [["x"]] * 20
    want = {("x",): 1.0, ("y",): 0.5, ("x", "y"): 0.5}
    assert got(mining.frequent_itemsets_tree(frame(spark, baskets), "items", 0.1)) == want
    assert got(mining.frequent_itemsets_tree(frame(spark, baskets).limit(0), "items", 0.1)) == {}
