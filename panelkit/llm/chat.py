"""Chat formatting: cumulative-snapshot collapse by rolling prefix hashes, then
rendering. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import lookup, table

# Turns of one rendered row and of one window: longer conversations go on in
# further rows, so no task holds a whole conversation of any length.
TURNS = 512

# The rendered form of one turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def _turn_hashes(position: Column) -> list[Column]:
    """Two 64-bit hashes of a turn at its position; nulls differ from empty."""
    parts = [position, F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, h1, h2): turns numbered 0.. within a conversation
    and the rolling hash of the prefix that ends with each.

    The prefix hash is the exclusive-or of position-dependent turn hashes, so it
    is a running aggregate. Both running aggregates go in two steps: inside a
    block of TURNS turn numbers (a bounded window), then over one row per block,
    so a conversation with any share of the rows is spread over its blocks.
    """
    turns = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"),
                                 F.col("text").cast("string").alias("text")).filter("conv_id is not null").distinct()
    turns = turns.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / TURNS))
    inside = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    local = turns.withColumn("i", F.row_number().over(inside) - 1)
    counts = local.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = (local.join(offsets.select("conv_id", "block", "base"), ["conv_id", "block"])
              .withColumn("pos", F.col("base") + F.col("i")))
    g1, g2 = _turn_hashes(F.col("pos"))
    running = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hashed = (placed.withColumn("g1", g1).withColumn("g2", g2)
              .withColumn("x1", F.bit_xor("g1").over(running)).withColumn("x2", F.bit_xor("g2").over(running)))
    ends = hashed.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("e1"), F.bit_xor("g2").alias("e2"))
    carried = ends.select("conv_id", "block", F.coalesce(F.bit_xor("e1").over(before), F.lit(0)).alias("c1"),
                          F.coalesce(F.bit_xor("e2").over(before), F.lit(0)).alias("c2"))
    return hashed.join(carried, ["conv_id", "block"]).select(
        "conv_id", "pos", "role", "text", F.col("x1").bitwiseXOR(F.col("c1")).alias("h1"),
        F.col("x2").bitwiseXOR(F.col("c2")).alias("h2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that are not a prefix of a
    longer one; of equal conversations the smallest conv_id.

    Proper prefixes and whole conversations are each reduced to distinct hashes
    by grouped aggregates (combined before the shuffle), so a first turn or a
    conversation that is repeated any number of times is one row on either side
    of the anti-join."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    marked = turns.select("conv_id", "pos", "h1", "h2").join(lengths, "conv_id")
    proper = marked.filter("pos + 1 < n_turns").select(
        (F.col("pos") + 1).alias("n_turns"), "h1", "h2").distinct()
    whole = (marked.filter("pos + 1 = n_turns").groupBy("n_turns", "h1", "h2")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")))
    return whole.join(proper, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns", "copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, copies, n_part_turns, rendered): the kept
    conversations as text, TURNS turns a row (part 0, 1, ... in order)."""
    piece = F.concat(F.lit(TURN_START), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")),
                     F.lit(TURN_END), F.lit("\n"))
    total = kept.agg(F.sum("n_turns")).first()[0] or 0
    chosen = lookup(turns.select("conv_id", "pos", piece.alias("piece")), kept, ["conv_id"], "n_turns", total) \
        .filter("n_turns is not null")
    parts = chosen.groupBy("conv_id", F.floor(F.col("pos") / TURNS).cast("bigint").alias("part")).agg(
        F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"),
        F.count(F.lit(1)).cast("bigint").alias("n_part_turns"),
        F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("pieces"))
    return parts.select("conv_id", "part", "n_turns", "copies", "n_part_turns",
                        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("rendered"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations of ``conversations(conv_id, turn, role, text)``, rendered.

    Turns are ordered by turn, then role, then text (nulls first); exact repeats
    of a turn row count once. Rows with a null conv_id belong to no conversation
    and are left out. Null roles and texts render as empty but differ from empty
    in comparisons. Empty table: empty result. Other columns are not read.
    """
    turns = cut_lineage(numbered_turns(conversations))
    kept = cut_lineage(maximal_conversations(turns))
    return render(turns, kept)


def op4(spark, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP4_SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos,
         coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n') || chr(2) AS raw,
         '{TURN_START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{TURN_END}' || chr(10) AS piece
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
p AS (
  SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(raw, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix
  FROM t),
whole AS (
  SELECT prefix, n_turns, min(conv_id) AS conv_id, count(*) AS copies
  FROM p WHERE pos + 1 = n_turns GROUP BY prefix, n_turns),
kept AS (
  SELECT w.* FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos + 1 < p.n_turns AND p.prefix = w.prefix))
SELECT k.conv_id, (t.pos // {TURNS})::BIGINT AS part, k.n_turns, k.copies, count(*)::BIGINT AS n_part_turns,
       string_agg(t.piece, '' ORDER BY t.pos) AS rendered
FROM kept k JOIN t ON t.conv_id = k.conv_id
GROUP BY k.conv_id, t.pos // {TURNS}, k.n_turns, k.copies
"""
