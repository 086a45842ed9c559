"""SimHash near-dedup: fingerprints, pivot distance tables, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import connected_components, lookup, map_arrow, merge_links, text_of

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 24
# A bucket with more fingerprints than this is cut further before comparison.
BUCKET_ROWS = 20_000
# Pairs of a bucket that are looked at in one numpy step.
PAIR_BLOCK = 1 << 18


def pivot_fingerprints(n: int = PIVOTS) -> np.ndarray:
    """``n`` fixed reference fingerprints: rows of the 64 x 64 Walsh matrix by
    falling bit count of their index, so any two differ in 32 bits."""
    at = np.arange(64, dtype=np.uint64)
    rows = [int(sum(1 << int(b) for b in at if bin(int(b) & k).count("1") & 1)) for k in range(64)]
    order = sorted(range(64), key=lambda k: (-bin(k).count("1"), k))
    return np.array([rows[k] for k in order[:n]], dtype=np.uint64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the text's word shingles, repeats included (no word: 0)."""
    toks = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, \x20 and \x09-\x0D
    if not toks:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(toks) <= words:
        return digest(b" ".join(toks), SEED)
    joined = b" ".join(toks)
    sizes = np.fromiter(map(len, toks), dtype=np.int64, count=len(toks))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    view = memoryview(joined)
    pairs = zip(starts[:len(toks) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)
    n = len(toks) - words + 1
    h = np.fromiter((digest(view[a:b], SEED) for a, b in pairs), dtype=np.uint64, count=n)
    over = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(h[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        over += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(over * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, text_hash, fp): fp is the fingerprint's 64 bits as a bigint."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                       text_of(text_col).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(2)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             ["id", "text_hash", "fp"])

    return map_arrow(rows, run, "id bigint, text_hash bigint, fp bigint")


def near_pairs(fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints at most ``max_bits`` apart, block by block.

    The pivot table holds each fingerprint's distance to every reference. As
    |d(x,p) - d(y,p)| <= d(x,y), a pair is dropped as soon as one coordinate
    differs by more than ``max_bits``: the first coordinate by sorting (only
    a window of it is paired), the others in turn. Survivors are verified."""
    coords = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)
    order = np.argsort(coords[:, 0], kind="stable")
    fps, coords = fps[order], coords[order]
    first = coords[:, 0]
    until = np.searchsorted(first, first + max_bits, side="right")  # partners i+1 .. until-1
    counts = until - np.arange(len(fps)) - 1
    done = np.concatenate([[0], np.cumsum(counts)])
    start = 0
    while start < len(fps):
        stop = max(start + 1, int(np.searchsorted(done, done[start] + PAIR_BLOCK, side="right")) - 1)
        n = counts[start:stop]
        i = np.repeat(np.arange(start, stop), n)
        j = np.arange(len(i)) - np.repeat(done[start:stop] - done[start], n) + i + 1
        for p in range(1, coords.shape[1]):
            near = np.abs(coords[i, p] - coords[j, p]) <= max_bits
            i, j = i[near], j[near]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        if near.any():
            yield order[i[near]], order[j[near]]
        start = stop


def _parts(free: int, n: int) -> list[int]:
    """``free`` (a set of bits) cut into at most ``n`` masks of about equal size."""
    bits = [b for b in range(64) if free >> b & 1]
    cut = np.array_split(np.array(bits, dtype=object), n)
    return [sum(1 << b for b in part) for part in cut if len(part)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def band_masks(max_bits: int) -> list[int]:
    """Masks such that fingerprints at most ``max_bits`` apart agree under one of
    them: of 2*max_bits blocks at least max_bits are untouched."""
    from itertools import combinations
    blocks = _parts((1 << 64) - 1, max(2 * max_bits, 1))
    if max_bits == 0:
        return [(1 << 64) - 1]
    return [sum(c) for c in combinations(blocks, len(blocks) - max_bits)]


def buckets(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(mask, key, fp) rows of distinct ``fps(fp)``: every linked pair shares a
    (mask, key). A bucket of over ``bucket_rows`` fingerprints is replaced by
    finer ones: its free bits are cut in max_bits + 1 parts, one of which a
    linked pair must agree on. Fingerprints are distinct, so this ends; no row
    or pair is dropped."""
    masks = [_signed(m) for m in band_masks(max_bits)]

    def keyed(df):
        return df.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")

    rows = keyed(fps.select("fp", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("mask")))
    # A bucket can only be over-full if each block under its mask is: counting
    # blocks first (a few thousand keys, combined before the shuffle) is cheap.
    blocks = [_signed(m) for m in _parts((1 << 64) - 1, max(2 * max_bits, 1))]
    full = (fps.select(F.explode(F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"),
                                                    F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("k"))
                                           for m in blocks])).alias("x"))
            .groupBy("x.m", "x.k").count().filter(F.col("count") > bucket_rows).limit(1).count())
    while full:
        over = cut_lineage(rows.groupBy("mask", "key").count().filter(F.col("count") > bucket_rows)
                           .select("mask", "key", F.lit(True).alias("over")))
        hot_masks = [r[0] for r in over.select("mask").distinct().collect()]  # a few masks, whatever the data
        if not hot_masks:
            break
        finer = [(m, _signed((m & (1 << 64) - 1) | part))
                 for m in hot_masks for part in _parts(~m & (1 << 64) - 1, max_bits + 1)]
        cut = fps.sparkSession.createDataFrame(finer, "mask bigint, finer bigint")
        marked = cut_lineage(rows.join(over, ["mask", "key"], "left"))
        rows = marked.filter("over is null").select("mask", "key", "fp").unionByName(
            keyed(marked.filter("over").join(F.broadcast(cut), "mask").select("fp", F.col("finer").alias("mask"))))
    return rows


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS, n_pivots: int = PIVOTS) -> DataFrame:
    """(u, v) fingerprints: a spanning forest of the links inside every bucket
    (not all pairs of it), enough for the components."""
    pivots = pivot_fingerprints(n_pivots)
    dealt = buckets(fps, max_bits, bucket_rows)
    dealt = dealt.repartition("mask", "key").sortWithinPartitions("mask", "key")

    def forest(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group = np.unique(group)
        parent = np.arange(len(group))
        for i, j in near_pairs(group.view(np.uint64), max_bits, pivots):
            parent = merge_links(parent, i, j)
        child = np.flatnonzero(parent != np.arange(len(group)))
        return group[child], group[parent[child]]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), dtype=np.int64)  # of the group that is not yet complete
        for b in it:
            cols = np.concatenate([held, np.array([c.to_numpy() for c in b.columns], dtype=np.int64)], axis=1)
            new = np.flatnonzero((cols[0, 1:] != cols[0, :-1]) | (cols[1, 1:] != cols[1, :-1])) + 1
            starts = np.concatenate([[0], new])
            held = cols[:, starts[-1]:] if cols.shape[1] else cols
            sizes = np.diff(starts)
            yield from emit(cols[2, a:a + n] for a, n in zip(starts[:-1][sizes > 1], sizes[sizes > 1], strict=True))
        if held.shape[1] > 1:
            yield from emit([held[2]])

    def emit(groups) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for g in groups:
            u, v = forest(g)
            us.append(u)
            vs.append(v)
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return map_arrow(dealt, run, "u bigint, v bigint")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: id_col, text_hash, fingerprint (16 hex digits),
    component_id, group_size, kept.

    Texts link when their fingerprints differ in at most ``max_bits`` bits;
    component_id is the smallest identifier reachable. Copies share a
    fingerprint and are one node. Null and text without words have fingerprint
    zero and link like others. Null identifiers are reported, never chosen as
    component_id unless there is no other (then it is null). kept: of each
    component, the rows with the smallest (identifier, text hash); so repeated
    rows stay together. Empty table: empty result.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, words))
    smallest = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("text_hash")))
    nodes = cut_lineage(prints.groupBy("fp").agg(smallest.alias("first"), F.count(F.lit(1)).alias("n")))
    comp = connected_components(links(nodes.select("fp"), max_bits, bucket_rows))
    named = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "first", "n", F.coalesce("component", "fp").alias("component"))
    best = named.groupBy("component").agg(F.min("first").alias("best"), F.sum("n").alias("group_size"))
    sizes = named.join(best, "component").select("fp", "n", "best", "group_size")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    out = lookup(prints, cut_lineage(sizes), ["fp"], "n", total)
    first = F.col("best")
    return out.select(
        F.col("id").alias(id_col), "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        first["id"].alias("component_id"), "group_size",
        (F.col("id").eqNullSafe(first["id"]) & (F.col("text_hash") == first["text_hash"])).alias("kept"))
