"""Registered queries of the subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import (ann_graph, arc_convert, bpe, minhash, mixing, quality_gam, suffix_tree, syncmers, token_align, token_counts,
               toxicity, turn_repair, unit_dedup)

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_nearest_neighbours": ann_graph.op3_nearest_neighbours,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_syncmer_fingerprints": syncmers.op5_syncmer_fingerprints,
    "op6_quality": quality_gam.op6_quality,
    "op7_bpe_encode_decode": bpe.op7_bpe_encode_decode,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_arc_to_warc": arc_convert.op9_arc_to_warc,
    "op10_substring_dedup": unit_dedup.op10_substring_dedup,
    "op11_repair_conversations": turn_repair.op11_repair_conversations,
    "op12_align_tokenizers": token_align.op12_align_tokenizers,
    "op13_lm_scores": suffix_tree.op13_lm_scores,
}
ORACLE_SQL = {
    "op4_mix_sources": mixing.ORACLE_OP4,
    "op9_arc_to_warc": arc_convert.ORACLE_OP9,
    "op11_repair_conversations": turn_repair.ORACLE_OP11,
}
