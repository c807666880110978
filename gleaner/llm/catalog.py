"""Registered queries of the training-data operators."""

from __future__ import annotations

from gleaner.llm import bpe, collocation, conversation, fingerprint, lm, packing, passages, quality, shard, simhash, token_count, topk, toxicity

QUERIES = {
    "op1_subsequence_kernel_toxicity": toxicity.q_toxicity,
    "op2_covering_simhash": simhash.q_simhash,
    "op3_collinear_passages": passages.q_passages,
    "op4_deleted_interpolation": lm.q_lm,
    "op5_sharding": shard.q_sharding,
    "op6_bpe_merge_replay": bpe.q_bpe,
    "op7_token_counts": token_count.q_token_counts,
    "op8_cutting_stock_packing": packing.q_packing,
    "op10_pivot_top_k": topk.q_top_k,
    "op9_compression_bands": quality.q_quality,
    "op11_locally_consistent_fingerprints": fingerprint.q_fingerprints,
    "op12_rank_convergence_repair": conversation.q_conversations,
    "op13_prefix_free_collocations": collocation.q_collocations,
}
ORACLES: dict[str, str] = {
    "op10_pivot_top_k": topk.ORACLE,
    "op12_rank_convergence_repair": conversation.ORACLE,
    "op13_prefix_free_collocations": collocation.ORACLE,
}
