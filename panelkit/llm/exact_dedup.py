"""Exact dedup: Patricia tries of whole texts, keyed by length and content hash."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import lookup, map_arrow, text_of

# Bytes of text a task's trie may hold before its largest subtrees are spilled.
TRIE_BYTES = 24 << 20
BATCH_BYTES = 4 << 20


class Node:
    __slots__ = ("label", "children", "owner", "count")

    def __init__(self, label: bytes, owner=None, count: int = 0):
        self.label, self.children, self.owner, self.count = label, {}, owner, count


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix (bisection over slice comparisons)."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Trie:
    """Compressed radix tries, one per (byte length, content hash). The node at
    which a text ends stores the owner (least or largest identifier) and the
    number of rows. ``take`` removes a subtree and returns its texts."""

    def __init__(self, least: bool):
        self.better = (lambda a, b: a < b) if least else (lambda a, b: a > b)
        self.roots: dict[tuple[int, int], Node] = {}
        self.size = 0

    def insert(self, key: tuple[int, int], raw: bytes, owner, count: int) -> None:
        node = self.roots.get(key)
        if node is None:
            self.roots[key] = Node(raw, owner, count)
            self.size += len(raw) + 200
            return
        rest, parent, edge = raw, None, 0
        while True:
            label = node.label
            if rest == label:
                if not node.count or (owner is not None and (node.owner is None or self.better(owner, node.owner))):
                    node.owner = owner
                node.count += count
                return
            n = _shared(rest, label)
            if n < len(label):  # split the edge
                upper = Node(label[:n])
                node.label = label[n:]
                upper.children[node.label[0]] = node
                if parent is None:
                    self.roots[key] = upper
                else:
                    parent.children[edge] = upper
                self.size += 200
                node = upper
                if n == len(rest):
                    node.owner, node.count = owner, count
                    return
            rest = rest[n:]
            parent, edge = node, rest[0]
            node = parent.children.get(edge)
            if node is None:
                parent.children[edge] = Node(rest, owner, count)
                self.size += len(rest) + 200
                return

    def take(self, key: tuple[int, int]) -> Iterator[tuple[bytes, object, int]]:
        """(text, owner, count) of every text under the key; the subtree goes."""
        todo = [(b"", self.roots.pop(key))]
        while todo:
            prefix, node = todo.pop()
            prefix += node.label
            self.size -= len(node.label) + 200
            if node.count:
                yield prefix, node.owner, node.count
            todo += [(prefix, child) for child in node.children.values()]


def _owners(rows: DataFrame, least: bool, keep_text: bool, trie_bytes: int) -> DataFrame:
    """(n_bytes, h, raw, owner, n) rows combined by tries, partition by partition.
    What a trie spills are whole subtrees as partial rows, which the next step
    combines; so a task holds ``trie_bytes`` and one batch at most. Without
    ``keep_text``: (n_bytes, sha, owner, n)."""
    fields = "n_bytes int, h bigint, raw binary, owner bigint, n bigint" if keep_text else \
        "n_bytes int, sha binary, owner bigint, n bigint"

    def batches(found) -> Iterator[pa.RecordBatch]:
        import hashlib
        out, size = [], 0

        def batch():
            cols = list(zip(*out, strict=True))
            if keep_text:
                return pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    ["n_bytes", "h", "raw", "owner", "n"])
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64())], ["n_bytes", "sha", "owner", "n"])

        for (length, h), raw, owner, count in found:
            out.append((length, h, raw, owner, count) if keep_text else
                       (length, hashlib.sha256(raw).digest(), owner, count))
            size += len(raw) if keep_text else 64
            if size >= BATCH_BYTES:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(least)

        def found():
            last = None
            for b in (x.slice(i, 256) for x in it for i in range(0, x.num_rows, 256)):
                cols = [c.to_pylist() for c in b.columns]
                for length, h, raw, owner, n in zip(*cols, strict=True):
                    key = (length, h)
                    if not keep_text and last is not None and key != last:
                        # sorted input: the last subtree is complete
                        yield from ((last, *x) for x in trie.take(last))
                    last = key
                    trie.insert(key, raw, owner, n)
                    if trie.size > trie_bytes:
                        keys = sorted(trie.roots, reverse=True)  # longest texts first
                        while keys and trie.size > trie_bytes // 2:
                            k = keys.pop(0)
                            yield from ((k, *x) for x in trie.take(k))
                        if last not in trie.roots:
                            last = None
            for k in list(trie.roots):
                yield from ((k, *x) for x in trie.take(k))

        yield from batches(found())

    return map_arrow(rows, run, fields)


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                 trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per different text: (n_bytes, sha, keep_id, group_size).

    Tries combine the copies inside each input partition first, so a text that
    makes up a third of all rows enters the shuffle once per task; the shuffle
    is by (length, hash), its sort makes every subtree complete in turn, and a
    last grouped aggregate joins what was spilled."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    least = keep == "smallest"
    raw = F.encode(text_of(text_col), "utf-8")
    rows = docs.select(F.octet_length(raw).alias("n_bytes"), F.xxhash64(raw).alias("h"), raw.alias("raw"),
                       F.col(id_col).cast("bigint").alias("owner"), F.lit(1).cast("bigint").alias("n"))
    local = _owners(rows, least, True, trie_bytes)
    dealt = local.repartition("n_bytes", "h").sortWithinPartitions("n_bytes", "h")
    merged = _owners(dealt, least, False, trie_bytes)
    pick = F.min if least else F.max
    return merged.groupBy("n_bytes", "sha").agg(pick("owner").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id (identifier of the row that stays),
    group_size, kept, text_sha256.

    Null texts count as empty and form one group with the empty ones. A null
    identifier owns a group only where all identifiers of the group are null
    (keep_id is then null and its rows are kept). Repeated rows with the owning
    identifier are all kept. Empty table: empty result. Other columns of
    ``docs`` are not read.
    """
    classes = cut_lineage(text_classes(docs, id_col, text_col, keep, trie_bytes))
    total = classes.agg(F.sum("group_size")).first()[0] or 0
    raw = F.encode(text_of(text_col), "utf-8")
    rows = docs.select(F.col(id_col).alias("__lx_id"), F.octet_length(raw).alias("n_bytes"),
                       F.unhex(F.sha2(raw, 256)).alias("sha"))
    found = lookup(rows, classes, ["n_bytes", "sha"], "group_size", total)
    return found.select(
        F.col("__lx_id").alias(id_col), "keep_id", "group_size",
        F.col("__lx_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
