"""Cross-tokenizer alignment: each distinct text is tokenised and aligned once."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage, scratch_path
from panelkit.llm.common import kept, lookup, map_arrow, table, text_of

# Characters of the texts of one block (one longer text is a block of its own)
# and of the slices in which a text is cut into words.
BLOCK_TEXT = 8 << 20
SLICE = 1 << 20
# Words that a worker remembers, and the longest of them.
MEMO_WORDS, MEMO_CHARS = 250_000, 256
# So many different (A, B) pairs (16 bytes each) are sent to the tasks; beyond
# that, every block fetches its own pairs through a shuffle.
BROADCAST_PAIRS = 4_000_000
# Different pairs that a counting task adds up before it hands them on.
TASK_PAIRS = 2_000_000

# A space after what is no white space: neither tokenizer joins across it. The
# classes are as wide as any library's notion of white space.
CUT = re.compile("(?<=[^\\s᠎​﻿]) ")
RUN = re.compile("[\\s᠎​﻿] ")

BLOCK_SCHEMA = ("block string, keys array<string>, copies array<bigint>, n_a array<bigint>, n_b array<bigint>, "
                "n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, words array<bigint>, "
                "codes binary, word_links binary, pairs binary")
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _byte_decoder() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable
    ones for themselves, the rest from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their entries, and the alignment of one word."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        byte = _byte_decoder()
        with open(path_a, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes_a[i] = (bytes(byte[c] for c in piece) if all(c in byte for c in piece)
                               else piece.encode())  # special entries
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        # a piece with a space mark after another character could join words
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.mark = [self.b.piece_to_id("▁")]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        ids = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.written = {c: np.array([f"{i}{c}" for i in ids], dtype=object) for c in ",|;"}

    def words(self, text: str) -> Iterator[list[str]]:
        """Lists of the words of space+text, in order, each without its first space."""
        if not self.cuts:
            yield [text]
            return
        at = 0
        while at <= len(text):
            m = CUT.search(text, at + SLICE) if len(text) - at > SLICE else None
            part = text[at:m.start() if m else len(text)]
            yield CUT.split(part) if RUN.search(part) or part.startswith(" ") else part.split(" ")
            at = m.end() if m else len(text) + 1

    def align(self, words: list[str]) -> list[tuple | None]:
        """Of each word: (n_a, n_b, n_groups, groups, pairs as int64 bytes); None if its
        bytes do not come back. All words are aligned at once, one after the other."""
        raw = [(" " + w).encode() for w in words]
        a = [e.ids for e in self.a.encode_batch([" " + w for w in words], add_special_tokens=False)]
        b = [x if w else self.mark for w, x in zip(words, self.b.encode(words), strict=True)]
        joined = b"".join(raw)
        good = range(len(words))
        for table_, ids in ((self.bytes_a, a), (self.bytes_b, b)):
            if b"".join([table_[i] for x in ids for i in x]) != joined:
                good = [k for k in good if b"".join([table_[i] for i in ids[k]]) == raw[k]]
        out: list[tuple | None] = [None] * len(words)
        for k, found in zip(good, self._aligned([a[k] for k in good], [b[k] for k in good]), strict=True):
            out[k] = found
        return out

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> Iterator[tuple]:
        if not a:
            return
        flat_a, flat_b = (np.fromiter((i for w in x for i in w), np.int64) for x in (a, b))
        last_a, last_b = (np.cumsum([len(w) for w in x]) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b])
        words = ends_a[last_a - 1]
        ends = np.union1d(ends_a, ends_b)  # each stretch between two ends is one link
        pairs = ((flat_a[np.searchsorted(ends_a, ends)] << 32) | flat_b[np.searchsorted(ends_b, ends)]) \
            .astype("<i8").tobytes()
        cuts = np.intersect1d(ends_a, ends_b)  # ends of the groups
        up_a, up_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # the written tokens in order: those of A, then those of B of every group
        parts = np.empty(len(flat_a) + len(flat_b), dtype=object)
        at_a = np.arange(len(flat_a)) + np.concatenate([[0], up_b])[group_a]
        at_b = np.arange(len(flat_b)) + up_a[group_b]
        parts[at_a], parts[at_b] = self.written[","][flat_a], self.written[","][flat_b]
        parts[at_a[up_a - 1]], parts[at_b[up_b - 1]] = self.written["|"][flat_a[up_a - 1]], self.written[";"][flat_b[up_b - 1]]
        parts = parts.tolist()
        n_links, n_groups = np.searchsorted(ends, words, "right"), np.searchsorted(cuts, words, "right")
        i = j = g = k = 0
        for i2, j2, g2, k2 in zip(last_a.tolist(), last_b.tolist(), n_groups.tolist(), n_links.tolist(), strict=True):
            yield i2 - i, j2 - j, g2 - g, "".join(parts[i + j:i2 + j2])[:-1], pairs[8 * k:8 * k2]
            i, j, g, k = i2, j2, g2, k2


class _Codes(dict):
    """Word -> number in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _worker(path_a: str, path_b: str) -> tuple[Tokenizers, dict]:
    own = kept("alignment")
    if own.get("paths") != (path_a, path_b):
        own.update(paths=(path_a, path_b), models=Tokenizers(path_a, path_b), memo={})
    return own["models"], own["memo"]


def _aligned_words(models: Tokenizers, memo: dict, words: list[str]) -> list[tuple | None]:
    new = [w for w in words if w not in memo]
    fresh = {}
    for i in range(0, len(new), 4096):
        fresh.update(zip(new[i:i + 4096], models.align(new[i:i + 4096]), strict=True))
    found = [fresh[w] if w in fresh else memo[w] for w in words]
    if len(memo) + len(fresh) > MEMO_WORDS:
        memo.clear()
    memo.update((w, x) for w, x in fresh.items() if len(w) <= MEMO_CHARS)
    return found


def _block(models: Tokenizers, memo: dict, keys: list[str], copies: list[int], codes: _Codes,
           coded: list[np.ndarray]) -> pa.RecordBatch:
    """One row: the texts' words as numbers, and the links of every different word."""
    found = _aligned_words(models, memo, list(codes))
    good = np.array([x is not None for x in found], bool)
    sizes = np.array([x[:3] if x is not None else (0, 0, 0) for x in found], np.int64).reshape(-1, 3)
    links = np.array([len(x[4]) // 8 if x is not None else 0 for x in found], np.int64)
    strings = [x[3] if x is not None else "" for x in found]
    sums, digests, words, flat = [], [], [], []
    for c in coded:
        ok = len(c) > 0 and bool(good[c].all())
        c = c if ok else c[:0]
        sums.append([*sizes[c].sum(axis=0).tolist(), int(links[c].sum())])
        digest = hashlib.sha256()
        for i in range(0, len(c), 1 << 16):
            digest.update(((";" if i else "") + ";".join([strings[k] for k in c[i:i + (1 << 16)].tolist()])).encode())
        digests.append(digest.hexdigest() if ok else "")
        words.append(len(c))
        flat.append(c)
    cols = list(zip(*sums, strict=True))
    pairs = [x[4] for x in found if x is not None]
    lists = [pa.array([list(x)]) for x in (keys, copies, *cols, digests, words)]
    raw = [np.concatenate(flat).astype("<u4").tobytes(), links.astype("<u4").tobytes(), b"".join(pairs)]
    return pa.RecordBatch.from_arrays([pa.array([keys[0]]), *lists, *[pa.array([x]) for x in raw]], [
        "block", "keys", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "words",
        "codes", "word_links", "pairs"])


def _align_task(path_a: str, path_b: str) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, memo = _worker(path_a, path_b)
        keys, copies, codes, coded, size = [], [], _Codes(), [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                parts = [np.fromiter(map(codes.__getitem__, w), np.uint32, len(w)) for w in models.words(text)] \
                    if text else []
                keys.append(batch.column("key")[i].as_py())
                copies.append(batch.column("copies")[i].as_py())
                coded.append(np.concatenate(parts) if parts else np.zeros(0, np.uint32))
                size += len(text)
                if size >= BLOCK_TEXT:
                    yield _block(models, memo, keys, copies, codes, coded)
                    keys, copies, codes, coded, size = [], [], _Codes(), [], 0
        if keys:
            yield _block(models, memo, keys, copies, codes, coded)
    return task


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    """(words of each text, word numbers, links of each word, pairs, first link of each word)."""
    links = np.frombuffer(row["word_links"], "<u4").astype(np.int64)
    return (np.array(row["words"], np.int64), np.frombuffer(row["codes"], "<u4"), links,
            np.frombuffer(row["pairs"], "<i8"), np.concatenate([[0], np.cumsum(links)]))


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs (of any lengths, none included)."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, n)
    return keys, out


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every pair, weighted by the copies of their texts, and the number of blocks."""
    keys, n, blocks = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    def out():
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n), pa.array(blocks)], ["pair", "n", "blocks"])
    for batch in batches:
        for row in batch.to_pylist():
            words, codes, links, pairs, _ = _arrays(row)
            weight = np.zeros(len(links), np.int64)
            np.add.at(weight, codes, np.repeat(np.array(row["copies"], np.int64), words))
            used = np.repeat(weight, links)
            k, c = _added(pairs[used > 0], used[used > 0])
            both = np.concatenate([keys, k])
            blocks = _added(both, np.concatenate([blocks, np.ones(len(k), np.int64)]))[1]
            keys, n = _added(both, np.concatenate([n, c]))
            if len(keys) > TASK_PAIRS:
                yield out()
                keys, n, blocks = keys[:0], n[:0], blocks[:0]
    if len(keys):
        yield out()


def _measured(row: dict, known: np.ndarray, n: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """The measures of a block's texts from the counts of its pairs (``known`` ascending)."""
    words, codes, links, pairs, _ = _arrays(row)
    own, at = np.unique(pairs, return_inverse=True)
    seat = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
    hit = known[seat] == own if len(known) else np.zeros(len(own), bool)  # words of unaligned texts only: no count
    counts, bests = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    counts[hit], bests[hit] = n[seat[hit]], best[seat[hit]]
    per_word = [_sums(x[at], links) for x in (bests, counts)]
    n_best, count_sum = (_sums(x[codes], words) for x in per_word)
    return pa.RecordBatch.from_arrays(
        [pa.array(row["keys"]), *[pa.array(row[c], pa.int64()) for c in ("copies", "n_a", "n_b", "n_groups", "n_links")],
         pa.array(n_best), pa.array(count_sum), pa.array(row["groups_sha256"])],
        ["key", "copies", *MEASURES, "groups_sha256"])


MEASURED = "key string, copies bigint, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", groups_sha256 string"


def aligned_blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``texts(text, copies)``, all different, as a written table of aligned blocks."""
    path = scratch_path(texts.sparkSession, "alignment")
    rows = texts.select(F.sha2(F.encode("text", "utf-8"), 256).alias("key"), "text", "copies")
    map_arrow(rows, _align_task(path_a, path_b), BLOCK_SCHEMA, "alignment") \
        .write.option("compression", "zstd").parquet(path)
    return texts.sparkSession.read.parquet(path)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, blocks, best): links of every (A id << 32 | B id) in all texts, in how
    many blocks it stands, and whether its count is the highest of its B id."""
    slim = blocks.select("copies", "words", "codes", "word_links", "pairs")
    counts = cut_lineage(map_arrow(slim, _count_task, "pair bigint, n bigint, blocks bigint", "alignment")
                         .groupBy("pair").agg(F.sum("n").alias("n"), F.sum("blocks").alias("blocks")))
    low = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    top = counts.groupBy(low.alias("b")).agg(F.max("n").alias("top"))  # at most one row an entry of B
    return counts.join(F.broadcast(top), low == F.col("b")).select(
        "pair", "n", "blocks", (F.col("n") == F.col("top")).cast("bigint").alias("best"))


def measures(blocks: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per different text: key (SHA-256), copies, MEASURES, groups_sha256."""
    sc = blocks.sparkSession.sparkContext
    if counts.count() <= broadcast_pairs:
        t = counts.select("pair", "n", "best").orderBy("pair").toArrow()
        shared = sc.broadcast([t.column(c).to_numpy() for c in ("pair", "n", "best")])

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _measured(row, *shared.value)
        return map_arrow(blocks, near, MEASURED, "alignment")

    def own_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = np.unique(np.frombuffer(row["pairs"], "<i8"))
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(own)), pa.array(own)], ["block", "pair"])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = sorted((x["pair"], x["n"], x["best"]) for x in row["found"] or [])
                yield _measured(row, *np.array(found, np.int64).reshape(-1, 3).T)

    wanted = map_arrow(blocks.select("block", "pairs"), own_pairs, "block string, pair bigint", "alignment")
    total = counts.agg(F.sum("blocks")).first()[0] or 0
    found = lookup(wanted, counts, ["pair"], "blocks", total).filter("n is not null") \
        .groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("found"))
    return map_arrow(blocks.join(found, "block", "left"), far, MEASURED, "alignment")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                     broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs``: id_col, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 (see README for the measures).

    Texts are shuffled by their full text; each different one is tokenised and
    aligned once, its links weighted by its copies. A is a byte-level BPE of the
    ``tokenizers`` library, B a SentencePiece BPE that adds a leading space.
    Texts are cut before spaces that follow other than white space: neither
    tokenizer joins across them (checked in B's pieces when loaded), so words are
    aligned one by one and remembered. A text without such spaces is one word
    (some 300 bytes of memory a character).

    Null and empty texts, and texts that either tokenizer does not give back byte
    for byte, have zeros and an empty groups_sha256, and no link is counted for
    them. Rows repeated with the same identifier (null too) stay as often as they
    come. Empty table: empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("text"))
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    blocks = aligned_blocks(texts, path_a, path_b)
    found = cut_lineage(measures(blocks, cut_lineage(pair_counts(blocks)), broadcast_pairs))
    total = found.agg(F.sum("copies")).first()[0] or 0
    keyed = rows.select(F.col(id_col).alias("__lx_id"), F.sha2(F.encode("text", "utf-8"), 256).alias("key"))
    out = lookup(keyed, found, ["key"], "copies", total)
    return out.select(F.col("__lx_id").alias(id_col), *MEASURES, "groups_sha256")


def op13(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
