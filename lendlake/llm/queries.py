"""The named queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations, decontaminate, hard_negatives, lm_scoring, minhash_dedup, mixing, quality, sharding, suffix_dedup,
    token_counts, topk, toxicity, warc_index,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        token_counts.op1_token_counts,
        toxicity.op2_toxicity,
        lm_scoring.op3_lm_scoring,
        warc_index.op4_warc_index,
        minhash_dedup.op5_minhash_dedup,
        suffix_dedup.op6_suffix_dedup,
        decontaminate.op7_decontaminate,
        mixing.op8_mix_sources,
        quality.op9_quality,
        topk.op10_exact_topk,
        hard_negatives.op11_hard_negatives,
        sharding.op12_shard_documents,
        conversations.op13_repair_conversations,
    )
}

CHECKS: dict[str, str] = {
    "op4_warc_index": warc_index.ORACLE_SQL,
    "op10_exact_topk": topk.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
}
