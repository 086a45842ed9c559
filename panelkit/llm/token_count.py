"""Count-only Viterbi over a unigram vocabulary found by Aho-Corasick."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import kept, map_arrow, table, text_of

# A character that no piece covers costs the worst score less this.
UNKNOWN_PENALTY = 10.0
# Word counts a worker remembers (emptied when full; only saves time).
MEMORY_ENTRIES = 250_000
MEMORY_LENGTH = 64
SPACE = "▁"


class UnigramCounter:
    """Numbers of pieces in the best segmentation of words.

    ``pieces``: (text, score). For each end position the automaton gives the
    pieces that end there, longest first; ``best[e] = max best[s] + score`` and
    the piece count travels with it. Ties: the tokenizer walks the starts from
    left to right and replaces only by something strictly better, so of equal
    candidates the one with the earliest start (the longest piece) stays; the
    unknown candidate comes last. An unknown character counts as its UTF-8
    bytes (byte fallback) or, without byte pieces, a run of them as one."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool, worst: float | None = None):
        self.auto = ahocorasick.Automaton()
        for text, score in pieces:
            if text:
                self.auto.add_word(text, (len(text), float(score)))
        self.auto.make_automaton()
        low = min((s for _, s in pieces), default=0.0) if worst is None else worst
        self.unknown, self.byte_fallback = low - UNKNOWN_PENALTY, byte_fallback
        self.memory: dict[str, tuple[int, int]] = {}

    def best(self, word: str) -> tuple[float, int, int]:
        """(best score, pieces, unknown characters) of one word."""
        n = len(word)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        tail = [False] * (n + 1)  # the best path ends with an unknown character
        found = self.auto.iter(word) if len(self.auto) else iter(())
        end, match = next(found, (n, None))
        penalty, fallback = self.unknown, self.byte_fallback
        for e in range(n):
            top, cnt, unk, single = None, 0, 0, False
            while end == e:
                size, s = match
                at = e + 1 - size
                value = score[at] + s
                if top is None or value > top:
                    top, cnt, unk = value, count[at] + 1, unknown[at]
                single = single or size == 1
                end, match = next(found, (n, None))
            if not single:
                value = score[e] + penalty
                if top is None or value > top:
                    top, unk = value, unknown[e] + 1
                    cnt = count[e] + (len(word[e].encode("utf-8", "surrogatepass")) if fallback else not tail[e])
                    tail[e + 1] = True
            score[e + 1], count[e + 1], unknown[e + 1] = top, cnt, unk
        return score[n], count[n], unknown[n]

    def count(self, text: str) -> tuple[int, int, int]:
        """(pieces, words, unknown characters). A word is a run of one space mark
        and what follows up to the next mark; a mark is put before the text."""
        memory, total, unknown = self.memory, 0, 0
        if not text:
            return 0, 0, 0
        words = text.replace(" ", SPACE).split(SPACE)
        if not words[0]:
            del words[0]  # the text already starts with a mark
        for w in words:
            got = memory.get(w)
            if got is None:
                got = self.best(SPACE + w)[1:]
                if len(w) <= MEMORY_LENGTH:
                    if len(memory) >= MEMORY_ENTRIES:
                        memory.clear()
                    memory[w] = got
            total += got[0]
            unknown += got[1]
        return total, len(words), unknown


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], bool, float]:
    """Ordinary pieces and scores of a SentencePiece model file, whether it has
    byte pieces, and the lowest score in the file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in ids
              if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    return pieces, any(sp.is_byte(i) for i in ids), min(sp.get_score(i) for i in ids)


def _counter(blob: bytes) -> UnigramCounter:
    key = hashlib.sha256(blob).digest()
    mine = kept("token_count")
    if key not in mine:
        mine.clear()
        mine[key] = UnigramCounter(*pickle.loads(blob))
    return mine[key]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_tokens, n_words, n_unknown), one per row of ``docs``.

    ``path``: a SentencePiece model file, whose pieces and scores are read as a
    unigram vocabulary. Words are split at spaces before segmentation; other
    white space is ordinary text. A narrow, per-row operator without shuffle.
    Null and empty texts have 0 tokens; repeated rows, null identifiers and
    long texts are counted as they are; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(read_vocabulary(path)))  # one vocabulary

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(shared.value)
        for b in it:
            got = np.array([c.count(t.as_py()) for t in b.column(1)], dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(got[:, i]) for i in range(3))],
                                             ["id", "n_tokens", "n_words", "n_unknown"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, run, f"id {kind}, n_tokens bigint, n_words bigint, n_unknown bigint", "token_count") \
        .withColumnRenamed("id", id_col)


def op3(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
