"""Queries of this subpackage and their DuckDB SQL, for the driver's registry."""

from __future__ import annotations

from . import ann, decontam, divergence, jaccard_join, langid, mixing, neardup, preference, sharding, spelling, token_orc, toxicity, urlfilter

QUERIES = {
    "op1_language_backoff": langid.op1_query,
    "op2_adaptive_scan_neighbours": ann.op2_query,
    "op3_flow_resharding": sharding.op3_query,
    "op4_orc_tokens": token_orc.op4_query,
    "op5_wu_manber_decontamination": decontam.op5_query,
    "op6_probminhash_near_duplicates": neardup.op6_query,
    "op7_temporal_url_list": urlfilter.op7_query,
    "op8_bradley_terry_quality": preference.op8_query,
    "op9_poisson_mixing": mixing.op9_query,
    "op10_factorization_toxicity": toxicity.op10_query,
    "op11_source_divergence": divergence.op11_query,
    "op12_spelling_composition": spelling.op12_query,
    "op13_jaccard_regions": jaccard_join.op13_query,
}

ORACLE = {
    "op7_temporal_url_list": urlfilter.OP7_SQL,
    "op9_poisson_mixing": mixing.OP9_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
}
