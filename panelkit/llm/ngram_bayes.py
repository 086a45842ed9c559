"""Hashed character n-gram likelihoods per class, counted by grouped aggregation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import blocks_of, codes_of, map_arrow

GRAM = 3
BUCKETS = 1 << 14
SMOOTHING = 0.5
CLASSES_AT_ONCE = 32  # whose counts and likelihoods are in memory at once, where there are more
WINDOW = 12  # grams of the windows whose best means are features


def grams(texts: list[str], lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every gram, index of each text's first gram, grams per text) of
    texts padded by one space on each side; texts without characters have none."""
    texts = [f" {t.lower() if lower else t} " if t else "" for t in texts]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    c = codes_of(texts).astype(np.uint64)
    if len(c) < GRAM:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    h = (c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:]
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (BUCKETS.bit_length() - 1))
    ends = np.cumsum(sizes)
    keep = np.ones(len(c), dtype=bool)
    last = ends[sizes > 0]
    keep[last - 1] = keep[last - 2] = False  # grams that run into the next text
    n = np.maximum(sizes - (GRAM - 1), 0)
    return h[keep[:len(h)]].astype(np.int64), np.cumsum(n) - n, n


def class_counts(rows: DataFrame, lower: bool) -> DataFrame:
    """(cls, bucket, n) over all of ``rows(cls, text)``. Tasks add up in dense
    arrays, so the shuffle gets a row per task, class and bucket at most."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in it:
            classes = np.array(b.column(0).to_pylist(), dtype=object)
            for start, texts in blocks_of(b.column(1)):
                g, _, n = grams(texts, lower)
                which = classes[start:start + len(texts)]
                own = np.repeat(np.arange(len(texts)), n)
                for cls in set(which):
                    got = total.setdefault(cls, np.zeros(BUCKETS, dtype=np.int64))
                    got += np.bincount(g[(which == cls)[own]], minlength=BUCKETS)
        for cls, got in total.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([cls] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(got[at])],
                ["cls", "bucket", "n"])

    return (map_arrow(rows.select("cls", "text"), run, "cls string, bucket int, n bigint")
            .groupBy("cls", "bucket").agg(F.sum("n").alias("n")))


def log_likelihoods(counts: DataFrame, classes: list[str]) -> np.ndarray:
    """Classes x BUCKETS matrix of smoothed log-probabilities (bounded by them)."""
    got = np.empty((len(classes), BUCKETS), dtype=np.float32)
    if len(classes) > CLASSES_AT_ONCE:
        counts = cut_lineage(counts)
    for i in range(0, len(classes), CLASSES_AT_ONCE):
        some = classes[i:i + CLASSES_AT_ONCE]
        at = {c: j for j, c in enumerate(some)}
        part = np.full((len(some), BUCKETS), SMOOTHING)
        for cls, bucket, n in (counts if len(some) == len(classes) else counts.filter(F.col("cls").isin(some))).collect():
            part[at[cls], bucket] += n
        got[i:i + len(some)] = np.log(part / part.sum(axis=1, keepdims=True))
    return got


def mean_scores(rows: DataFrame, model: np.ndarray, lower: bool, peaks: bool = False) -> DataFrame:
    """``rows`` with ``ll`` (array<double>: mean log-likelihood per gram and
    class) and ``n_grams``; with ``peaks`` also ``peak`` (array<double>: for each
    class but the first, the largest mean over WINDOW grams of its
    log-likelihood less the first's) and ``n_words``; ``text`` goes. One narrow
    pass."""
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    others = [c for c in rows.columns if c != "text"]
    k = model.shape[0]

    def lists(parts: list[np.ndarray], width: int) -> pa.Array:
        flat = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * width), pa.array(flat.ravel()))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in it:
            lls, counts, words, tops = [], [], [], []
            for _, texts in blocks_of(b.column(b.num_columns - 1)):
                g, first, n = grams(texts, lower)
                sums = np.zeros((len(texts), k))
                some = np.flatnonzero(n)
                top = np.zeros((len(texts), k - 1))
                if len(some):
                    for j in range(0, k, CLASSES_AT_ONCE):
                        each = table[:, j:j + CLASSES_AT_ONCE][g]
                        sums[some, j:j + CLASSES_AT_ONCE] = np.add.reduceat(each, first[some], axis=0, dtype=np.float64)
                    if peaks:
                        each = table[g] if k > CLASSES_AT_ONCE else each
                        ends = np.arange(len(g)) + 1
                        begin = np.maximum(ends - WINDOW, np.repeat(first[some], n[some]))
                        for j in range(k - 1):
                            run_sum = np.concatenate([[0.0], np.cumsum(each[:, j + 1] - each[:, 0], dtype=np.float64)])
                            top[some, j] = np.maximum.reduceat(run_sum[ends] - run_sum[begin], first[some]) / WINDOW
                lls.append(sums / np.maximum(n, 1)[:, None])
                counts.append(n)
                if peaks:
                    tops.append(top)
                    words += [len(t.split()) for t in texts]
            if not lls:
                continue
            out = [*b.columns[:-1], lists(lls, k), pa.array(np.concatenate(counts))]
            names = [*others, "ll", "n_grams"]
            if peaks:
                out += [lists(tops, k - 1), pa.array(words, pa.int64())]
                names += ["peak", "n_words"]
            yield pa.RecordBatch.from_arrays(out, names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*others).schema.fields)
    return map_arrow(rows.select(*others, "text"), run, f"{kinds}, ll array<double>, n_grams bigint"
                     + (", peak array<double>, n_words bigint" if peaks else ""))


def fit_softmax(x: np.ndarray, y: np.ndarray, weight: np.ndarray, k: int, ridge: float = 1e-3,
                rounds: int = 60) -> np.ndarray:
    """Weighted multinomial logistic regression (Newton steps) of classes ``y`` on
    a few features; returns k x (features + 1) coefficients, class 0 at zero."""
    x = np.hstack([x, np.ones((len(x), 1))])
    d = x.shape[1]
    w = np.zeros((k - 1, d))
    target = np.eye(k)[y][:, 1:]
    weight = weight / weight.sum()

    def loss(v):
        z = np.hstack([np.zeros((len(x), 1)), x @ v.T])
        m = z.max(axis=1)
        return (weight * (np.log(np.exp(z - m[:, None]).sum(axis=1)) + m - z[np.arange(len(x)), y])).sum() \
            + ridge / 2 * (v * v).sum()

    now = loss(w)
    for _ in range(rounds):
        z = np.hstack([np.zeros((len(x), 1)), x @ w.T])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p = (p / p.sum(axis=1, keepdims=True))[:, 1:]
        grad = ((p - target) * weight[:, None]).T @ x + ridge * w
        hess = np.zeros(((k - 1) * d, (k - 1) * d))
        for a in range(k - 1):
            for b in range(k - 1):
                r = weight * p[:, a] * ((a == b) - p[:, b])
                hess[a * d:(a + 1) * d, b * d:(b + 1) * d] = (x * r[:, None]).T @ x
        move = np.linalg.solve(hess + ridge * np.eye(len(hess)), grad.ravel()).reshape(w.shape)
        step = 1.0
        while step > 1e-6 and (new := loss(w - step * move)) > now:
            step /= 2
        if step <= 1e-6 or now - new < 1e-12:
            break
        w, now = w - step * move, new
    return np.vstack([np.zeros((1, d)), w])
