"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import alignment, chat, embed_dedup, langid, mixing, pii, repair, token_count, toxicity, wrapper
from panelkit.llm.bpe import encode_digests
from panelkit.llm.common import table
from panelkit.llm.exact_dedup import exact_dedup
from panelkit.llm.simhash import simhash_dedup


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "kept")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": langid.op1,
        "op2_toxicity": toxicity.op2,
        "op3_token_counts": token_count.op3,
        "op4_chat_formatting": chat.op4,
        "op5_exact_dedup": op5,
        "op6_simhash_dedup": op6,
        "op7_embedding_dedup": embed_dedup.op7,
        "op8_mixing": mixing.op8,
        "op9_byte_bpe": op9,
        "op10_pii": pii.op10,
        "op11_html_extraction": wrapper.op11,
        "op12_conversation_repair": repair.op12,
        "op13_tokenizer_alignment": alignment.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_formatting": chat.OP4_SQL, "op5_exact_dedup": OP5_SQL, "op7_embedding_dedup": embed_dedup.OP7_SQL}
