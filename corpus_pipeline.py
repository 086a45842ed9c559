"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage's rows as Parquet into
the shared folder and reads them again for the next.

Whole texts go through a shuffle only where more rows are dropped than may be
broadcast (``drop_rows``); decisions travel as (doc_id, text hash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import cut_lineage, scratch_path
from panelkit.llm.bpe import encode_digests
from panelkit.llm.common import table, text_of
from panelkit.llm.exact_dedup import exact_dedup
from panelkit.llm.langid import identify, train_text_model
from panelkit.llm.mixing import mix
from panelkit.llm.simhash import simhash_dedup

# Decisions about at most so many rows (24 bytes each) are broadcast; more are shuffled.
BROADCAST_DECISIONS = 250_000


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__lx_id": F.col("doc_id").cast("bigint"), "__lx_h": F.xxhash64(text_of("text"))})


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _sized(decisions: DataFrame) -> DataFrame:
    return F.broadcast(decisions) if decisions.count() <= BROADCAST_DECISIONS else decisions


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text hash) are in ``dropped(id, h)``."""
    rows, gone = _keyed(docs), _sized(cut_lineage(dropped.distinct()))
    match = rows["__lx_id"].eqNullSafe(gone["id"]) & (rows["__lx_h"] == gone["h"])
    return rows.join(gone, match, "left_anti").select(*_own(docs))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each different (doc_id, text) of ``docs``. ``found(id, h)`` has
    a row for each; only if some repeat do the texts have to be shuffled."""
    r = found.groupBy("id", "h").count().agg(F.max("count")).first()
    if (r[0] or 0) <= 1:
        return docs
    return _keyed(docs).dropDuplicates(["__lx_id", "__lx_h"]).select(*_own(docs))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told. The text model is counted over all texts
    with a declared language; ``lang`` is the declared language and ``source``
    the host. Documents that no language explains go; nulls add no evidence."""
    languages, model = train_text_model(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text_of("text")).alias("h"),
                       text_of("text").alias("text"), F.lower("lang").alias("declared"),
                       F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"),
                       F.lit(None).cast("string").alias("domain"))
    found = identify(rows, languages, model, ["id", "h"])
    return drop_rows(docs, found.filter("rejected").select("id", "h"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id. Rows that
    repeat both doc_id and text stay once."""
    found = exact_dedup(docs.select("doc_id", "text"), keep="largest")
    gone = cut_lineage(found.filter("not kept").select(F.col("doc_id").alias("id"), "text_sha256"))
    kept = cut_lineage(found.filter("kept").select(F.col("doc_id").alias("id"), "text_sha256"))
    rows = docs.withColumns({"__lx_id": F.col("doc_id").cast("bigint"),
                             "__lx_h": F.sha2(F.encode(text_of("text"), "utf-8"), 256)})
    gone = _sized(gone.distinct())
    match = rows["__lx_id"].eqNullSafe(gone["id"]) & (rows["__lx_h"] == gone["text_sha256"])
    left = rows.join(gone, match, "left_anti").select(*_own(docs))
    return one_of_each(left, kept.withColumnRenamed("text_sha256", "h"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id (of equal ones
    the smallest text hash). Rows that repeat both stay once."""
    found = cut_lineage(simhash_dedup(docs.select("doc_id", "text"))
                        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), "kept"))
    left = drop_rows(docs, found.filter("not kept").select("id", "h"))
    return one_of_each(left, found.filter("kept").select("id", "h"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them (not at all, once, or more
    often where a domain is raised). Rows of (doc_id, text) repeat alike."""
    found = cut_lineage(mix(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
                        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), "copies").distinct())
    left = drop_rows(docs, found.filter("copies = 0").select("id", "h"))
    more = _sized(cut_lineage(found.filter("copies > 1").selectExpr(
        "id AS __lx_id2", "h AS __lx_h2", "copies AS __lx_copies")))
    rows = _keyed(left)
    match = rows["__lx_id"].eqNullSafe(more["__lx_id2"]) & (rows["__lx_h"] == more["__lx_h2"])
    times = F.sequence(F.lit(1), F.coalesce("__lx_copies", F.lit(1)))
    return rows.join(more, match, "left").withColumn("__lx_copy", F.explode(times)).select(*_own(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' number and digests of every document, encoded and decoded."""
    import public_tokenizers
    return encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

# Likelihood models, fingerprints and merges are beyond SQL; tests hold every
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
