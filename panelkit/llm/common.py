"""Shared helpers: text blocks inside tasks, skew-safe lookups, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage

# A key that holds at least 1/HEAVY_SHARE of all rows is "heavy": at most
# HEAVY_SHARE such keys can exist, whatever the input, so they may be broadcast.
HEAVY_SHARE = 1000

# Code points handled at once inside a task (bounds numpy temporaries).
BLOCK_CHARS = 1 << 18


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# What a Python worker keeps between tasks (vocabularies, tables), by operator.
_KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The worker's memory of an operator; it goes when a task of another one starts."""
    return _KEPT.setdefault(operator, {})


def _release() -> None:
    """Freed memory goes back to the system: workers outlive tasks and stages."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def _task(operator: str, run: Callable, batches: Iterator) -> Iterator:
    for other in [k for k in _KEPT if k != operator]:
        del _KEPT[other]
    yield from run(batches)
    _release()


def map_arrow(df: DataFrame, task: Callable, schema: str, operator: str = "") -> DataFrame:
    """``mapInArrow`` whose tasks can import this package (its sources go to the
    executors once per application through Spark's own file distribution) and
    leave no memory behind but what ``operator`` keeps."""
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_panelkit_shipped", False):
        root = Path(__file__).resolve().parent.parent
        path = os.path.join(tempfile.mkdtemp(prefix="panelkit-src-"), "panelkit_src.zip")
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(path)
        sc._panelkit_shipped = True
    return df.mapInArrow(lambda batches: _task(operator, task, batches), schema)


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def blocks_of(texts, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of consecutive texts (an Arrow array) of about ``limit`` characters
    (one longer text makes a run of its own); yields (index of the first, texts)."""
    start, size, run = 0, 0, []
    for at in range(0, len(texts), 128):
        for i, t in enumerate(texts.slice(at, 128).to_pylist(), at):
            t = t or ""
            if run and size + len(t) > limit:
                yield start, run
                start, size, run = i, 0, []
            run.append(t)
            size += len(t)
    if run:
        yield start, run


def codes_of(texts: Iterable[str]) -> np.ndarray:
    """Code points of the joined texts."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def lookup(rows: DataFrame, found: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``found`` (unique on ``keys``; ``size`` = its number
    of rows in ``rows``), safe when one key holds a large share of the rows.

    Heavy keys (at least total/HEAVY_SHARE rows, so at most HEAVY_SHARE of them)
    are answered from a broadcast; the rows they answer are then spread over
    salts that match nothing, so the shuffle join sees no hot key. Rows with a
    null key match nothing and are spread too.
    """
    values = [c for c in found.columns if c not in keys]
    heavy = (found.filter(F.col(size) * HEAVY_SHARE >= F.lit(max(total, 1))).limit(2 * HEAVY_SHARE)
             .select(*keys, F.struct(*values).alias("__lx_heavy")))
    light = found.select(*keys, F.lit(0).alias("__lx_salt"), F.struct(*values).alias("__lx_light"))
    alone = F.col("__lx_heavy").isNull()
    for k in keys:
        alone = alone & F.col(k).isNotNull()
    spread = F.when(alone, F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys] or keys), F.lit(4096)).cast("int") + 1)
    out = (rows.join(F.broadcast(heavy), keys, "left").withColumn("__lx_salt", spread)
           .join(light, [*keys, "__lx_salt"], "left"))
    got = F.coalesce("__lx_heavy", "__lx_light")
    return out.select(*rows.columns, *[got[c].alias(c) for c in values])


def _signature(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)`` (bigint): component is
    the smallest node reachable. Alternating large-star and small-star rounds
    (O(log^2 n) of them) end at a star per component; every round is written to
    the shared checkpoint folder. The joins meet hubs only as sort-merge joins
    against one row per node, which AQE may split."""
    cur = cut_lineage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct())
    sig = _signature(cur)
    for _ in range(max_rounds):
        if sig[0] == 0:
            break
        sym = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low2, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = cut_lineage(moved.unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        new = _signature(nxt)
        cur = nxt
        if new == sig:
            break
        sig = new
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def merge_links(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union the links (i, j) into ``parent`` (each entry points at a smaller or
    equal index; fully compressed on return)."""
    while len(i):
        a, b = parent[i], parent[j]
        keep = a != b
        i, j, a, b = i[keep], j[keep], a[keep], b[keep]
        if not len(i):
            break
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


class HashTable:
    """Open-addressed int64 -> float32 table for vectorised lookups in tasks."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3 + 1))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)  # keys are not negative
        self.values = np.zeros(1 << bits, dtype=np.float32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found)."""
        at = self._slot(keys)
        seen = self.keys[at]
        found = seen == keys
        out = np.where(found, self.values[at], np.float32(0))
        left = np.flatnonzero(~found & (seen != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            seen = self.keys[at]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[hit]]
            found[left[hit]] = True
            more = ~hit & (seen != -1)
            left, at = left[more], at[more]
        return out, found
