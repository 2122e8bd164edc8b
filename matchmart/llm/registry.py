"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from matchmart.llm import (
    exact_dedup,
    fingerprints,
    licenses,
    mixing,
    near_dedup,
    packing,
    preferences,
    quality,
    repeats,
    resampling,
    sharding,
    spelling,
    token_counts,
)

QUERIES = {
    "op1_soft_mixing": mixing.op1_soft_mixing,
    "op2_minhash_near_dedup": near_dedup.op2_minhash_near_dedup,
    "op3_edit_aware_counts": token_counts.op3_edit_aware_counts,
    "op4_preference_pairs": preferences.op4_preference_pairs,
    "op5_weak_supervision": quality.op5_weak_supervision,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_recompression_dedup": repeats.op7_recompression_dedup,
    "op8_chunk_recipe_dedup": exact_dedup.op8_chunk_recipe_dedup,
    "op9_hash_tree_shards": sharding.op9_hash_tree_shards,
    "op10_configuration_packing": packing.op10_configuration_packing,
    "op11_importance_resampling": resampling.op11_importance_resampling,
    "op12_multiset_fingerprints": fingerprints.op12_multiset_fingerprints,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLE = {
    "op2_minhash_near_dedup": near_dedup.ORACLE,
    "op4_preference_pairs": preferences.ORACLE,
    "op7_recompression_dedup": repeats.ORACLE,
    "op8_chunk_recipe_dedup": exact_dedup.ORACLE,
    "op9_hash_tree_shards": sharding.oracle(),
    "op11_importance_resampling": resampling.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}
