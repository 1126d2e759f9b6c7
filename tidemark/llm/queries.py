"""The text operators' queries and the SQL that checks them."""

from __future__ import annotations

from tidemark.llm import archives, chat, decontamination, exact_dedup, language, merkle, mixing, near_dedup, negatives, pii, quality, sharding, toxicity

QUERIES = {
    "op1_sampled_splitters": sharding.op1_sampled_splitters,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_candidate_boosting": pii.op3_candidate_boosting,
    "op4_arc_to_warc": archives.op4_arc_to_warc,
    "op5_winnowing": decontamination.op5_winnowing,
    "op6_stream_dedup": exact_dedup.op6_stream_dedup,
    "op7_order_minhash": near_dedup.op7_order_minhash,
    "op8_snapshot_collapse": chat.op8_snapshot_collapse,
    "op9_ftrl": toxicity.op9_ftrl,
    "op10_nearest_centroid": language.op10_nearest_centroid,
    "op11_bond_negatives": negatives.op11_bond_negatives,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_subword_embeddings": quality.op13_subword_embeddings,
}
ORACLE_SQL = {
    "op2_mix_sources": mixing.OP2_SQL,
    "op4_arc_to_warc": archives.OP4_SQL,
    "op5_winnowing": decontamination.OP5_SQL,
    "op6_stream_dedup": exact_dedup.OP6_SQL,
    "op8_snapshot_collapse": chat.OP8_SQL,
    "op11_bond_negatives": negatives.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
}
