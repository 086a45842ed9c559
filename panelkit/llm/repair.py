"""Conversation structure repair: Wagner-Fischer alignment of turns with the
alternating grammar string, in Ukkonen bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import kept, lookup, map_arrow, table

# Costs of the edits, and what counts as white space and as an end.
RELABEL, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}

# Rows that are aligned at once; longer conversations are aligned block by block
# and the blocks' costs put together by the state of the grammar between them.
BLOCK_ROWS = 512
# Alignments that a worker remembers (conversations with like faults have the same).
MEMO = 200_000

FAR = 1 << 29
# What the grammar s?(ua)+ expects: anything, u after s, u after a, a after u.
START, AFTER_S, WANT_U, WANT_A = range(4)


def _greedy(rows: str, state: int) -> int:
    """The cost of relabelling whatever does not fit (an upper bound)."""
    cost = 0
    for r in rows:
        if r == "d":
            cost += DELETE
            continue
        cost += CUT_OFF * r.isupper()
        r = r.lower()
        if r == "s" and state == START:
            state = AFTER_S
            continue
        cost += RELABEL * (r != ("a" if state == WANT_A else "u"))
        state = WANT_U if state == WANT_A else WANT_A
    return cost


class Alignment:
    """Costs of aligning every tail of ``rows`` with the last t symbols of the
    alternating string that ends in ``last``: one banded table for all lengths.

    ``rows`` has a letter a row: d must be deleted; s, u, a or o is the initial of
    the role (o: any other), upper case if the row is truncated."""

    def __init__(self, rows: str, last: str, most: int):
        self.rows, self.last = rows, last
        n = len(rows)
        free = np.array([r != "d" for r in rows], dtype=bool)
        left = np.concatenate([np.cumsum(free[::-1])[::-1], [0]]).astype(int)  # free rows from i on
        spare = max(most - DELETE * int((~free).sum()), 0)
        # beyond the band the surplus of rows or symbols alone costs more than ``most``
        low, high = np.maximum(left - spare // DELETE, 0), left + spare // INSERT
        self.width = int(high[0]) + 1
        t = np.arange(self.width)
        odd = "a" if last == "a" else "u"
        wants_a = (t % 2 == 1) == (odd == "a")  # first of the last t symbols
        self.cost = np.full((n + 1, self.width), FAR, dtype=np.int64)
        self.cost[n, :high[n] + 1] = INSERT * t[:high[n] + 1]
        for i in range(n - 1, -1, -1):
            a, b = int(low[i]), int(high[i]) + 1
            best = self.cost[i + 1, a:b] + DELETE
            if free[i]:
                r = rows[i].lower()
                own = CUT_OFF * rows[i].isupper() + RELABEL * (
                    ~wants_a[a:b] if r == "a" else wants_a[a:b] if r == "u" else np.ones(b - a, dtype=bool))
                s = max(a, 1)
                best[s - a:] = np.minimum(best[s - a:], self.cost[i + 1, s - 1:b - 1] + own[s - a:])
            ramp = INSERT * t[a:b]
            self.cost[i, a:b] = np.minimum(np.minimum.accumulate(best - ramp) + ramp, FAR)
        self.wants_a = wants_a

    def audit(self, i: int, t: int) -> str:
        """The least of the cheapest edit strings from row i on, t symbols left."""
        out, n, cost = [], len(self.rows), self.cost
        while i < n or t:
            c = cost[i, t]
            if i < n and cost[i + 1, t] + DELETE == c:
                out.append("D")
                i += 1
            elif t and cost[i, t - 1] + INSERT == c:
                out.append("I")
                t -= 1
            else:
                out.append("K" if self.rows[i].lower() == ("a" if self.wants_a[t] else "u") else "R")
                i, t = i + 1, t - 1
        return "".join(out)


def align_block(rows: str, entries: tuple[int, ...], exits: tuple[int, ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """(entry, exit) -> (cost, least audit) of the cheapest edits of ``rows`` that
    lead the grammar from one state to the other."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    n = len(rows)
    all_gone = (DELETE * n, "D" * n)
    first = [(i, DELETE * i + CUT_OFF * (r == "S")) for i, r in enumerate(rows) if r in "sS"]
    for e in entries:
        if e in exits:
            out[e, e] = all_gone  # an empty stretch of the string
        if e == START and AFTER_S in exits:  # s alone
            for i, c in first:
                out[START, AFTER_S] = min(out.get((START, AFTER_S), (FAR, "")),
                                          (c + DELETE * (n - i - 1), "D" * i + "K" + "D" * (n - i - 1)))
    for x, last in ((WANT_U, "a"), (WANT_A, "u")):
        if x not in exits:
            continue
        most = max(_greedy(rows, e) for e in entries) + 2 * INSERT
        table_ = Alignment(rows, last, most)
        for e in entries:
            # the stretch starts with u, or with a after u: that fixes the parity of its length
            parity = int((e == WANT_A) == (x == WANT_U))
            lengths = np.arange(parity or 2, table_.width, 2)
            found = [(table_.cost[0, lengths], -1)]
            if e == START:
                found += [(table_.cost[i + 1, lengths] + c, i) for i, c in first]
            best = min([int(c.min()) for c, _ in found if len(c)] + [FAR])
            if best >= FAR or best > out.get((e, x), (FAR, ""))[0]:
                continue
            audits = []
            for c, i in found:  # every length of that cost is traced back
                for t in lengths[c == best].tolist():
                    audits.append(table_.audit(0, t) if i < 0 else "D" * i + "K" + table_.audit(i + 1, t))
            out[e, x] = min(out.get((e, x), (FAR, "")), (best, min(audits)))
    return out


class Repair:
    """Aligns one conversation, whose rows come in any number of pieces."""

    def __init__(self, block_rows: int = BLOCK_ROWS):
        self.block_rows, self.rows, self.size = block_rows, [], 0
        self.states: dict[int, tuple[int, str]] = {START: (0, "")}

    def add(self, rows: str) -> None:
        self.rows.append(rows)
        self.size += len(rows)
        if self.size >= 2 * self.block_rows:
            rows = "".join(self.rows)
            while len(rows) >= 2 * self.block_rows:
                self._step(rows[:self.block_rows], (START, AFTER_S, WANT_U, WANT_A))
                rows = rows[self.block_rows:]
            self.rows, self.size = [rows], len(rows)

    def _step(self, rows: str, exits: tuple[int, ...]) -> None:
        # equal costs: no audit of as many rows is another's beginning, so the least stays least
        new: dict[int, tuple[int, str]] = {}
        for (e, x), (c, a) in align_block(rows, tuple(self.states), exits).items():
            cost, audit = self.states[e]
            new[x] = min(new.get(x, (FAR * FAR, "")), (cost + c, audit + a))
        self.states = new

    def result(self) -> tuple[int, str]:
        self._step("".join(self.rows), (START, WANT_U))
        return min(self.states.values())


def repair_rows(rows: str, block_rows: int = BLOCK_ROWS) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, the ASCII-least audit of equal costs."""
    memo = kept("repair")
    if rows not in memo:
        if len(memo) >= MEMO:
            memo.clear()
        r = Repair(block_rows)
        r.add(rows)
        if len(rows) > 64:
            return r.result()
        memo[rows] = r.result()
    return memo[rows]


def damaged(conversations: DataFrame) -> DataFrame:
    """(ck, conv_id, turn, role, text, copies): the rows after damage by
    crc32(conv_id:turn) % 20 (copies 0: dropped); nulls of role and text are one space."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(shown("text"), "[.!?]", "")) \
        .otherwise(shown("text"))
    return conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("-")).alias("ck"), "conv_id", "turn",
        F.when(hit == 4, F.lit("user")).otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
AUDITED = "ck string, " + ", ".join(f"{c} bigint" for c in STATS) + ", audit string"


def _audit_task(block_rows: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by conversation and turn -> faults, cost and audit of each."""
        done: list[tuple] = []
        ck = None

        def finish() -> None:
            nonlocal letters, whole
            if whole is not None:
                whole.add("".join(letters))
                cost, audit = whole.result()
            else:
                cost, audit = repair_rows("".join(letters), block_rows)
            gaps = int(high) - int(low) + 1 - turns if turns else 0
            done.append((ck, gaps, *faults, illegal, cost, audit))

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), *[pa.array(c, pa.int64()) for c in cols[1:-1]], pa.array(cols[-1])],
                ["ck", *STATS, "audit"])

        for batch in batches:
            names = ("ck", "turn", "role", "h", "initial", "blank", "cut", "copies", "late")
            for key, turn, role, h, initial, blank, cut, copies, late in zip(
                    *(batch.column(c).to_pylist() for c in names), strict=True):
                if key != ck:
                    if ck is not None:
                        finish()
                    ck, letters, whole, faults = key, [], None, [0, 0, 0]
                    low = high = seen = before = None
                    turns = illegal = 0
                if not copies:
                    continue
                if turn is not None and turn != high:
                    low, high, turns = (turn if low is None else low), turn, turns + 1
                if before is not None:
                    illegal += (before + initial) not in LEGAL
                illegal += copies - 1
                before = initial
                again = late or seen == (turn, role, h)
                seen = (turn, role, h)
                if blank:
                    faults[0] += copies
                    letters.append("d" * copies)
                elif again:
                    faults[1] += copies
                    letters.append("d" * copies)
                else:
                    faults[1] += copies - 1
                    faults[2] += cut
                    letter = initial if initial in ("s", "u", "a") else "o"
                    letters.append((letter.upper() if cut else letter) + "d" * (copies - 1))
                if len(letters) >= 2 * block_rows:
                    whole = whole or Repair(block_rows)
                    whole.add("".join(letters))
                    letters = []
            if done:
                yield flushed()
        if ck is not None:
            finish()
            yield flushed()
    return task


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, followed by its rows in order -> digest of the repaired rows."""
    done: list[tuple[str, str]] = []
    ck = None

    def put(role: str, text: str) -> None:
        nonlocal empty
        digest.update((("" if empty else "\n") + role + ":" + text).encode())
        empty = False

    def insert() -> None:
        nonlocal at, want
        while at < len(audit) and audit[at] == "I":
            put(want, "")
            at, want = at + 1, "assistant" if want == "user" else "user"

    def finish() -> None:
        insert()
        done.append((ck, digest.hexdigest()))

    def flushed() -> pa.RecordBatch:
        keys, hashes = zip(*done, strict=True)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(hashes)], ["ck", "repaired_sha256"])

    for batch in batches:
        names = ("ck", "audit", "role", "text", "copies")
        for key, own, role, text, copies in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if own is not None:
                if ck is not None:
                    finish()
                ck, audit, at, want, digest, empty = key, own, 0, "user", hashlib.sha256(), True
                continue
            for _ in range(copies):
                insert()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                put(want if edit == "R" else role, text)
                if edit == "R" or role[:1] != "s":  # a kept system row leaves u wanted
                    want = "assistant" if want == "user" else "user"
        if done:
            yield flushed()
    if ck is not None:
        finish()
        yield flushed()


def repair_conversations(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conv_id of ``conversations(conv_id, turn, role, text)`` after the
    damage of ``damaged``: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.

    Rows are taken by turn (nulls first), of equal turns by role, then by SHA-256
    of the text. Rows with null conv_id are one conversation (conv_id null). Null
    roles and texts are one space. Repeated rows count as often as they come.
    Conversations without rows after damage have zeros, an empty audit and the
    digest of nothing. Empty table: empty result. Other columns are not read.

    Duplicates are found by a grouped minimum of (conversation, role, SHA-256 of
    the text) and a look-up safe against hot keys. Flags without texts, then
    texts behind the audit, go to one task per conversation as sorted streams: a
    task holds one Arrow batch, ``block_rows`` rows of the alignment and the
    audits (the result's own cell), never a conversation's rows.
    """
    rows = damaged(conversations)
    bare = F.rtrim("text", F.lit(SPACE))
    flags = rows.select(
        "ck", "conv_id", "turn", "role", F.sha2(F.encode("text", "utf-8"), 256).alias("h"),
        F.left("role", F.lit(1)).alias("initial"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("cut"), "copies")
    names = flags.groupBy("ck").agg(F.max("conv_id").alias("conv_id"))
    firsts = flags.filter("copies > 0 and not blank").groupBy("ck", "role", "h").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("turn")).alias("first")).filter("n > 1")
    total = cut_lineage(firsts)
    size = flags.count()
    marked = lookup(flags.drop("conv_id"), total, ["ck", "role", "h"], "n", size).withColumn(
        "late", F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("n", "first")
    ordered = marked.repartition("ck").sortWithinPartitions("ck", "turn", "role", "h")
    audits = cut_lineage(map_arrow(ordered, _audit_task(block_rows), AUDITED, "repair"))
    texts = rows.filter("copies > 0").select(
        "ck", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies",
        F.sha2(F.encode("text", "utf-8"), 256).alias("h"))
    heads = audits.select("ck", "audit", *[F.lit(None).cast(t).alias(c) for c, t in texts.dtypes[2:]])
    behind = heads.unionByName(texts).repartition("ck").sortWithinPartitions(
        "ck", F.col("audit").isNull(), "turn", "role", "h").select("ck", "audit", "role", "text", "copies")
    hashes = map_arrow(behind, _hash_task, "ck string, repaired_sha256 string", "repair")
    return names.join(audits, "ck").join(hashes, "ck").select("conv_id", *STATS, "audit", "repaired_sha256")


def op12(spark, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))
