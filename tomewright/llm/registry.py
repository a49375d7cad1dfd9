"""The queries of this subpackage, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tomewright.llm import align, ann, bpe, chat, decontaminate, fingerprint, langid, lexical, linededup, lm, neardup, shard, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": neardup.op1_minhash_near_dedup,
    "op2_lm_scoring": lm.op2_lm_scoring,
    "op3_language_id": langid.op3_language_id,
    "op4_sharding": shard.op4_sharding,
    "op5_bpe": bpe.op5_bpe,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_nearest_neighbours": ann.op7_nearest_neighbours,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_fingerprints": fingerprint.op11_fingerprints,
    "op12_token_alignment": align.op12_token_alignment,
    "op13_ranked_search": lexical.op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": neardup.ORACLE_SQL,
    "op6_chat_formatting": chat.ORACLE_SQL,
    "op10_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op13_ranked_search": lexical.ORACLE_SQL,
}
