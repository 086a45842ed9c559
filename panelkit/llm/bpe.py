"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import HashTable, blocks_of, kept, map_arrow, text_of

# Encodings that a worker remembers (two generations of so many; this only saves
# time), and the longest string it remembers one for.
MEMORY_ENTRIES = 250_000
MEMORY_LENGTH = 64

# Pre-tokens merged side by side (``Lanes``): so many at once, and only those of
# so many bytes or fewer. Texts are looked through in runs of about so many characters.
LANES = 4096
LANE_BYTES = 48
RUN_CHARS = 1 << 20
MAX_IDS = 1 << 20


# Fixed value: the split pattern whose pre-tokens take at most one space, in front.
SPACE_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


class Memory:
    """Bounded memory of two generations, string -> ids (as the bytes of 32-bit
    numbers): the older generation is dropped when the younger is full, and what
    is used again moves to the younger."""

    def __init__(self, entries: int = MEMORY_ENTRIES):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.entries = entries

    def older(self, key: str) -> bytes | None:
        """For a key that the younger generation lacks."""
        got = self.old.get(key)
        if got is not None:
            self.put(key, got)
        return got

    def put(self, key: str, ids: bytes) -> None:
        if len(key) <= MEMORY_LENGTH:
            if len(self.young) >= self.entries:
                self.old, self.young = self.young, {}
            self.young[key] = ids


def _lowest(x: np.ndarray) -> np.ndarray:
    """Find-first-set: the number of the lowest bit set in each word."""
    return np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64)


class Lanes:
    """The rank queue of ``BytePairCodec.merge`` for many short pre-tokens at once,
    one a lane: in every round each lane takes its own next rank.

    A pair that can come up in a lane is a stretch of its bytes that is a piece.
    These stretches, in the order (rank, position), are the lane's buckets: bit j
    of its ``low`` words stands for its j-th stretch and a bit of ``top`` marks a
    word in use, so that two find-first-set steps give the lowest rank, leftmost
    first. The lists are linked over the bytes of all lanes end to end; a stretch
    whose two halves are no longer neighbours is stale and skipped."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, singles: list[int]):
        self.flat, self.starts, self.lengths = flat, starts, lengths
        self.singles = np.array(singles, dtype=np.int64)
        ranks = np.flatnonzero((lengths >= 2) & (lengths <= LANE_BYTES))
        hashes = np.zeros(len(ranks), dtype=np.uint64)
        for i in range(LANE_BYTES):
            more = lengths[ranks] > i
            hashes[more] = self._step(hashes[more], flat[starts[ranks[more]] + i])
        self.table = HashTable(self._key(hashes), ranks)
        self.longest = int(lengths[ranks].max(initial=0))

    @staticmethod
    def _step(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return h * np.uint64(0x9E3779B97F4A7C15) + byte.astype(np.uint64) + np.uint64(1)

    @staticmethod
    def _key(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) & np.uint64((1 << 63) - 1)).astype(np.int64)

    def _stretches(self, raw: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, length, rank) of every stretch inside a lane that is a piece."""
        at, h, found = np.arange(len(raw)), self._step(np.zeros(len(raw), dtype=np.uint64), raw), []
        for n in range(2, self.longest + 1):
            fits = at + n <= end[at]
            at, h = at[fits], h[fits]
            if not len(at):
                break
            h = self._step(h, raw[at + n - 1])
            rank, seen = self.table.get(self._key(h))
            s, r = at[seen], rank[seen].astype(np.int64)
            offsets = np.arange(n)
            same = (self.lengths[r] == n) & (raw[s[:, None] + offsets] == self.flat[
                np.minimum(self.starts[r][:, None] + offsets, len(self.flat) - 1)]).all(axis=1)
            found.append((s[same], np.full(int(same.sum()), n), r[same]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def merge(self, pretokens: list[bytes]) -> list[bytes]:
        """Token ids of each pre-token (none of them empty or itself a piece), as
        the bytes of 32-bit numbers."""
        raw = np.frombuffer(b"".join(pretokens), dtype=np.uint8)
        sizes = np.array([len(x) for x in pretokens])
        stop = np.cumsum(sizes)
        n, lanes = len(raw), len(sizes)
        lane = np.repeat(np.arange(lanes), sizes)
        s, length, rank = self._stretches(raw, stop[lane])
        order = np.lexsort((s, rank, lane[s]))
        s, length, rank = s[order], length[order], rank[order]
        held = np.bincount(lane[s], minlength=lanes)
        base = np.cumsum(held) - held
        bit = np.arange(len(s)) - base[lane[s]]
        width = int(sizes.max()) + 1
        bits = np.full((n, width), -1, dtype=np.int32)  # (position, length) -> bit of the lane
        bits[s, length] = bit
        words = int(held.max(initial=0)) // 64 + 1
        low, top = np.zeros((lanes, words), dtype=np.uint64), np.zeros(lanes, dtype=np.uint64)
        one, gone = np.uint64(1), n + 1  # merged positions lead to ``gone``, which leads nowhere
        nxt, prv = np.arange(1, n + 3), np.arange(-1, n)
        nxt[gone] = -1
        prv[stop - sizes] = -1

        def push(who, position, size):
            b = bits[position, np.minimum(size, width - 1)]
            ok = (b >= 0) & (size < width)
            who, b = who[ok], b[ok]
            low[who, b >> 6] |= one << (b & 63).astype(np.uint64)
            top[who] |= one << (b >> 6).astype(np.uint64)

        for i in range(width - 2):  # the i-th pair of bytes of every lane that has one
            who = np.flatnonzero(sizes > i + 1)
            push(who, (stop - sizes)[who] + i, np.full(len(who), 2))
        live = np.flatnonzero(top)
        while len(live):
            w = _lowest(top[live])
            word = low[live, w]
            j = base[live] + (w << 6) + _lowest(word)
            word &= word - one
            low[live, w] = word
            top[live] &= ~np.where(word == 0, one << w.astype(np.uint64), np.uint64(0))
            i, k = s[j], s[j] + length[j]
            middle = nxt[i]
            fresh = nxt[middle] == k
            who, i, k, middle = live[fresh], i[fresh], k[fresh], middle[fresh]
            nxt[i], nxt[middle] = k, gone
            inside = k < stop[who]
            prv[k[inside]] = i[inside]
            push(who[inside], i[inside], nxt[k[inside]] - i[inside])
            h = prv[i]
            inside = h >= 0
            push(who[inside], h[inside], k[inside] - h[inside])
            live = live[top[live] != 0]
        first = np.flatnonzero(nxt[:n] != gone)
        size = nxt[first] - first
        ids = self.singles[raw[first]]
        longer = size > 1
        at = first[longer]
        ids[longer] = rank[base[lane[at]] + bits[at, size[longer]]]
        ends = (4 * np.cumsum(np.bincount(lane[first], minlength=lanes))).tolist()
        packed = ids.astype(np.int32).tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class BytePairCodec:
    """Ranks of byte strings, the split pattern, and both directions."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.pieces = {r: b for b, r in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.splits_at_space = pattern == SPACE_PATTERN
        size = max(self.pieces, default=-1) + 1
        if size > MAX_IDS:
            raise ValueError(f"ids must be below {MAX_IDS}: two of them are kept in one number")
        # rank of every pair of ids whose bytes together are a piece; of two bytes
        self.pairs: dict[int, int] = {}
        for whole, rank in self.ranks.items():
            for cut in range(1, len(whole)):
                a, b = self.ranks.get(whole[:cut]), self.ranks.get(whole[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 20 | b] = rank
        self.singles = [self.ranks.get(bytes([i]), -1) for i in range(256)]
        self.first = [[self.ranks.get(bytes([a, b])) for b in range(256)] for a in range(256)]
        self.buckets: list[int | list[int] | None] = [None] * size  # see merge
        self.low = [0] * ((size >> 8) + 1)
        # ids by chunk (the text after a space) and of pre-tokens without a space
        self.chunks, self.plain = Memory(MEMORY_ENTRIES), Memory(MEMORY_ENTRIES // 8)
        # decoding tables: all pieces end to end, where each starts, how long it is
        self.lengths = np.array([len(self.pieces.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.known = np.array([i in self.pieces for i in range(size)], dtype=bool)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.pieces.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.lanes = Lanes(self.flat, self.starts, self.lengths, self.singles)

    def merge(self, raw: bytes) -> list[int]:
        """Token ids of one pre-token: always the lowest rank next, leftmost first.

        The queue: ``buckets[rank]`` holds the positions whose pair has that rank
        (None, one position, or a heap of them); a word of ``low`` marks 256
        ranks in use and a bit of ``top`` each word in use, so two find-first-set
        steps lead to the next rank. Positions are those of a linked list over
        the bytes. An entry is stale, and skipped, if the pair at its position
        has another rank by now. The queue is empty between pre-tokens and its
        arrays are reused; so the cost of a merge does not depend on the length
        of the pre-token (but for heaps of equal pairs)."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        low, buckets, top, get, first = self.low, self.buckets, 0, self.pairs.get, self.first
        ids = [self.singles[x] for x in raw]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        # rank of the pair that starts here
        rank_at = [first[a][b] for a, b in zip(raw, raw[1:], strict=False)]
        rank_at.append(None)
        fresh = [(r, i) for i, r in enumerate(rank_at) if r is not None]
        while True:
            for rank, i in fresh:
                held = buckets[rank]
                if held is None:
                    buckets[rank] = i
                    w = rank >> 8
                    low[w] |= 1 << (rank & 255)
                    top |= 1 << w
                elif type(held) is int:
                    buckets[rank] = [held, i] if held < i else [i, held]
                else:
                    heappush(held, i)
            if not top:
                break
            w = (top & -top).bit_length() - 1
            word = low[w]
            bit = word & -word
            rank = (w << 8) + bit.bit_length() - 1
            i = buckets[rank]
            if type(i) is not int:
                held = i
                i = heappop(held)
                if not held:
                    held = None
            else:
                held = None
            if held is None:
                buckets[rank] = None
                word ^= bit
                low[w] = word
                if not word:
                    top ^= 1 << w
            fresh = ()
            if rank_at[i] != rank:
                continue  # stale
            ids[i] = rank
            j = nxt[i]
            rank_at[j] = None
            k = nxt[i] = nxt[j]
            h = prv[i]
            r = None
            if k < n:
                prv[k] = i
                r = get(rank << 20 | ids[k])
                if r is not None:
                    fresh = ((r, i),)
            rank_at[i] = r
            if h >= 0:
                r = get(ids[h] << 20 | rank)
                if r != rank_at[h]:
                    rank_at[h] = r
                    if r is not None:
                        fresh += ((r, h),)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = nxt[i]
        return out

    def packed(self, raw: bytes) -> bytes:
        """``merge`` as the bytes of 32-bit numbers."""
        return np.array(self.merge(raw), dtype=np.int32).tobytes()

    def pretokens(self, text: str) -> bytes:
        """Ids of a stretch of text, pre-token by pre-token."""
        out: list[bytes] = []
        for piece in self.find(text):
            if piece[0] == " " and len(piece) > 1:
                memory, key = self.chunks, piece[1:]  # a chunk of one pre-token has the same ids
            else:
                memory, key = self.plain, piece
            ids = memory.young.get(key) or memory.older(key)
            if ids is None:
                ids = self.packed(piece.encode("utf-8", "surrogatepass"))
                if memory is self.plain or not (key[0].isspace() or key[-1].isspace()):
                    memory.put(key, ids)
            out.append(ids)
        return b"".join(out)

    def learn(self, texts: list[str]) -> None:
        """The new chunks between single spaces of some texts go to the memory;
        what has to be merged for them is merged side by side. ``parts`` finds
        them there, and encodes itself whatever is left out here."""
        if not self.splits_at_space:
            return
        new: set[str] = set()
        for t in texts:
            new.update(t.split(" "))
        split, need = [], set()
        for c in new.difference(self.chunks.young).difference(self.chunks.old):
            if not c or len(c) > MEMORY_LENGTH:
                continue
            if c.isascii() and c.isalpha():
                need.add(" " + c)  # letters are one pre-token
            elif c == c.strip():
                pieces = self.find(" " + c)
                need.update(pieces)
                if len(pieces) > 1:
                    split.append((c, pieces))
        ids: dict[str, bytes] = {}
        todo: list[tuple[bytes, str]] = []
        for p in need:
            memory, key = (self.chunks, p[1:]) if p[0] == " " and len(p) > 1 else (self.plain, p)
            got = memory.young.get(key) or memory.old.get(key)
            if got is not None:
                ids[p] = got
                continue
            raw = p.encode("utf-8", "surrogatepass")
            if len(raw) <= LANE_BYTES and raw not in self.ranks:
                todo.append((raw, p))
            else:
                ids[p] = self.packed(raw)
                memory.put(key, ids[p])
        todo.sort(key=lambda x: len(x[0]))
        for a in range(0, len(todo), LANES):
            some = todo[a:a + LANES]
            for (_, p), got in zip(some, self.lanes.merge([raw for raw, _ in some]), strict=True):
                ids[p] = got
                if p[0] == " " and len(p) > 1:
                    self.chunks.put(p[1:], got)
                else:
                    self.plain.put(p, got)
        for c, pieces in split:
            self.chunks.put(c, b"".join(map(ids.__getitem__, pieces)))

    def parts(self, text: str) -> list[bytes]:
        """The text's ids, packed for each chunk between single spaces.

        A pre-token never runs across a space that stands between two characters
        other than white space: it starts at that space. So such chunks, each
        with its space, are encoded (and remembered) apart; chunks that touch
        other white space are joined with their neighbours first."""
        if not self.splits_at_space:
            return [self.pretokens(text)] if text else []
        chunks = text.split(" ")
        memory = self.chunks
        out = list(map(memory.young.get, chunks))
        first = chunks[0]
        out[0] = self.pretokens(first) if first else b""
        if not first and len(chunks) > 1 or first[-1:].isspace():
            return self._joined(chunks)
        if None in out:
            missing = [i for i, x in enumerate(out) if x is None]
            for i in missing:
                c = chunks[i]
                if not c or c[0].isspace() or c[-1].isspace():
                    return self._joined(chunks)
            for i in missing:
                out[i] = self._chunk(chunks[i])
        return out

    def _chunk(self, c: str) -> bytes:
        ids = self.chunks.young.get(c) or self.chunks.older(c)
        if ids is None:
            ids = self.pretokens(" " + c)
            if c not in self.chunks.young:
                self.chunks.put(c, ids)
        return ids

    def _joined(self, chunks: list[str]) -> list[bytes]:
        out, i, n = [], 0, len(chunks)
        while i < n:
            j = i + 1  # the stretch i .. j - 1 ends where a single space separates two non-spaces
            while j < n and (not chunks[j - 1] or chunks[j - 1][-1].isspace()
                             or not chunks[j] or chunks[j][0].isspace()):
                j += 1
            if j == i + 1 and i:
                out.append(self._chunk(chunks[i]))
            else:
                out.append(self.pretokens((" " if i else "") + " ".join(chunks[i:j])))
            i = j
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.parts(text)), dtype=np.int32).tolist()

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes end to end, how many each id gave) of any number of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id outside the vocabulary")
        n = self.lengths[ids]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(self.starts[ids] - first, n)
        return self.flat[at], n


def codec(rank_file: bytes, pattern: str) -> BytePairCodec:
    """The worker's codec for this vocabulary (one is kept at a time)."""
    key = hashlib.sha256(rank_file + pattern.encode()).digest()
    mine = kept("bpe")
    if key not in mine:
        mine.clear()
        mine[key] = BytePairCodec(rank_file, pattern)
    return mine[key]


def read_ranks(path: str) -> bytes:
    """The rank file as bytes (read by the driver, shipped with the tasks)."""
    with open(path, "rb") as f:
        return f.read()


# Ids handled in one record batch of the result.
BATCH_IDS = 250_000


def _encode_batch(c: BytePairCodec, b: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """(ids of rows, lists of token ids) for stretches of a batch of (id, text)."""
    def stretch(start, parts, sizes):
        flat = np.frombuffer(b"".join(parts), dtype=np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return b.column(0).slice(start, len(sizes)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    parts, sizes, size, start = [], [], 0, 0
    for first, texts in blocks_of(b.column(1), RUN_CHARS):
        c.learn(texts)
        for i, t in enumerate(texts, first):
            got = c.parts(t)
            parts += got
            sizes.append(sum(map(len, got)) >> 2)
            size += sizes[-1]
            if size >= BATCH_IDS:
                yield stretch(start, parts, sizes)
                parts, sizes, size, start = [], [], 0, i + 1
    if sizes:
        yield stretch(start, parts, sizes)


def _decode_lists(c: BytePairCodec, lists: pa.ListArray) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, row after the last, decoded bytes) for stretches of id lists."""
    flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    start = 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BATCH_IDS, side="right")) - 1)
        raw, n = c.decode(flat[offsets[start]:offsets[stop]])
        ends = np.concatenate([[0], np.cumsum(n)])[offsets[start:stop + 1] - offsets[start]]
        yield start, stop, pa.Array.from_buffers(pa.binary(), stop - start, [
            None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
        start = stop


def _codes(df: DataFrame, task, rank_file: bytes, pattern: str, id_col: str, fields: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast((rank_file, pattern))  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*shared.value)
        for b in batches:
            yield from task(c, b)

    kind = df.schema["id"].dataType.simpleString()
    return map_arrow(df, run, f"id {kind}, {fields}", "bpe").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Rows (id_col, ids array<int>): the ids of each whole text without special
    tokens. A narrow, per-row operator: no shuffle, and nothing is kept across
    rows but the worker's bounded memory of encodings.

    Null and empty texts give an empty list; repeated rows and null ids are
    kept as they are; other columns of ``docs`` are not read; an empty table
    gives an empty one.
    """
    def task(c, b):
        for ids, lists in _encode_batch(c, b):
            yield pa.RecordBatch.from_arrays([ids, lists], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return _codes(rows, task, rank_file, pattern, id_col, "ids array<int>")


def decode(encoded: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Rows (id_col, ids, decoded binary): the bytes that ``ids`` stand for. Null
    lists decode to no bytes; an id outside the vocabulary raises."""
    def task(c, b):
        for start, stop, raw in _decode_lists(c, b.column(1)):
            n = stop - start
            yield pa.RecordBatch.from_arrays([b.column(0).slice(start, n), b.column(1).slice(start, n), raw],
                                             ["id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return _codes(rows, task, rank_file, pattern, id_col, "ids array<int>, decoded binary")


def round_trip(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass over the rows."""
    def task(c, b):
        for ids, lists in _encode_batch(c, b):
            for start, stop, raw in _decode_lists(c, lists):
                n = stop - start
                yield pa.RecordBatch.from_arrays([ids.slice(start, n), lists.slice(start, n), raw],
                                                 ["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return _codes(rows, task, rank_file, pattern, id_col, "ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256, all derived from the ids and the bytes decoded from them."""
    out = round_trip(docs, read_ranks(path), pattern, id_col, text_col)
    return out.select(
        F.col(id_col), F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
