"""Predictions of a fitted boosted model over blocks of rows.

Spark's models walk every tree node by node for each row. Here a tree is a set of
its leaves as one 64-bit word: what a feature's value rules out is looked up once
for a tree, and the first leaf that no feature rules out is the row's leaf. Leaves
and values are those of the fitted model; sums run over the trees in their order.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

MAX_LEAVES = 64        # bits of a word
TABLE_ENTRIES = 1024   # a table of several features' values stays within the first-level cache
BLOCK_ROWS = 16_384

_TREE = re.compile(r"Tree \d+ \(weight (\S+)\):$")
_IF = re.compile(r"If \(feature (\d+) <= (\S+)\)$")
_LEAF = re.compile(r"Predict: (\S+)$")


def parsed(text: str) -> list[tuple[float, list[tuple[int, float, int, int]], list[float]]] | None:
    """Weight, nodes (feature, threshold, first leaf below, first leaf below the right child) and leaf values of
    each tree of ``toDebugString``; None if a split is not a threshold or a tree has too many leaves."""
    trees: list = []
    for line in map(str.strip, text.splitlines()[1:]):
        if not line or line.startswith("Else (feature"):
            continue
        if (head := _TREE.match(line)) is not None:
            weight, nodes, leaves, above = float(head[1]), [], [], []
            trees.append((weight, nodes, leaves))
        elif trees and (split := _IF.match(line)) is not None:
            above.append([int(split[1]), float(split[2]), len(leaves), None])
        elif trees and (leaf := _LEAF.match(line)) is not None:
            leaves.append(float(leaf[1]))
            while above and above[-1][3] is not None:  # this leaf ends its right child
                nodes.append(tuple(above.pop()))
            if above:
                above[-1][3] = len(leaves)
        else:
            return None
    return trees if all(0 < len(leaves) <= MAX_LEAVES for _, _, leaves in trees) else None


def predictor(model, features: int) -> Callable[[list[np.ndarray]], np.ndarray] | None:
    """Predictions of a fitted ``GBTRegressionModel`` for rows given by their feature columns (without nulls
    or NaN); None for any other model. The function goes to the tasks whole, without this module."""
    from pyspark.ml.regression import GBTRegressionModel
    if not isinstance(model, GBTRegressionModel):
        return None
    trees = parsed(model.toDebugString)
    if not trees or len(trees) != model.getNumTrees or model.numFeatures != features:
        return None
    cuts = [np.unique([t for _, nodes, _ in trees for f, t, _, _ in nodes if f == i and t == t])
            for i in range(features)]
    groups: list[list[tuple[int, int]]] = []
    size = TABLE_ENTRIES + 1
    for i in sorted((i for i in range(features) if any(f == i for _, nodes, _ in trees for f, *_ in nodes)),
                    key=lambda i: len(cuts[i])):
        n = len(cuts[i]) + 1
        if size * n > TABLE_ENTRIES:
            groups.append([])
            size = 1
        groups[-1].append((i, size))
        size *= n
    tables = []
    for _, nodes, leaves in trees:
        of = {}
        for f, t, first, end in nodes:  # values above the threshold rule out the leaves on the left
            left = np.uint64(((1 << end) - 1) ^ ((1 << first) - 1))
            word = of.setdefault(f, np.full(len(cuts[f]) + 1, np.uint64((1 << len(leaves)) - 1)))
            word[np.searchsorted(cuts[f], t) + 1 if t == t else 0:] &= ~left
        row = []
        for group in groups:
            table = np.array([(1 << len(leaves)) - 1], np.uint64)
            for f, _ in group:
                word = of.get(f, np.full(len(cuts[f]) + 1, np.uint64((1 << len(leaves)) - 1)))
                table = (word[:, None] & table[None, :]).ravel()
            row.append(table.view(np.int64))
        tables.append(row)
    values = [np.array(leaves) * weight for weight, _, leaves in trees]
    rows = BLOCK_ROWS

    def predict(columns: list[np.ndarray]) -> np.ndarray:
        n = len(columns[0])
        out = np.zeros(n)
        for a in range(0, n, rows):
            b = min(a + rows, n)
            codes = [sum(np.searchsorted(cuts[f], columns[f][a:b]) * step for f, step in g) for g in groups]
            left, word, total = np.empty(b - a, np.int64), np.empty(b - a, np.int64), out[a:b]
            for row, value in zip(tables, values, strict=True):
                if len(value) == 1:
                    total += value[0]
                    continue
                np.take(row[0], codes[0], out=left, mode="clip")
                for table, code in zip(row[1:], codes[1:], strict=True):
                    left &= np.take(table, code, out=word, mode="clip")
                np.negative(left, out=word)
                word &= left  # its lowest bit, a power of two: the exponent is the leaf
                leaf = word.astype(np.float64).view(np.int64)
                leaf >>= 52
                leaf &= 0x7FF
                leaf -= 1023
                total += np.take(value, leaf, mode="clip")
        return out

    return predict
