"""Registered queries of the training-data operators: ``opN_<name>`` over
whole tables, with production parameters, and DuckDB SQL where it can
express the result."""

from __future__ import annotations

from footlink.llm import (
    curriculum,
    fingerprints,
    minhash_dedup,
    multi_index,
    piece_encoder,
    pseudonyms,
    quality_embedding,
    quality_rules,
    shuffle_shards,
    substring_dedup,
    target_resampling,
    toxicity,
    vector_codes,
)

QUERIES = {
    "op1_toxicity_nnpu": toxicity.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_fingerprints": fingerprints.query,
    "op4_shuffle_shards": shuffle_shards.query,
    "op5_quality_embedding": quality_embedding.query,
    "op6_pseudonyms": pseudonyms.query,
    "op7_circulant_minhash": minhash_dedup.query,
    "op8_curriculum_mix": curriculum.query,
    "op9_piece_encoder": piece_encoder.query,
    "op10_quality_rules": quality_rules.query,
    "op11_multi_index": multi_index.query,
    "op12_vector_codes": vector_codes.query,
    "op13_target_resampling": target_resampling.query,
}

ORACLES = {"op8_curriculum_mix": curriculum.ORACLE}
