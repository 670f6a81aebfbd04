"""The queries of the operators, and the SQL that states their results where SQL can."""

from __future__ import annotations

from lakestar.llm import (
    curriculum, fill_middle, importance, jaccard_join, license_scan, line_dedup, piece_trie, quality_model, quality_rules, simhash_index,
    substring_dedup, surrogates, topk_search,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_topk_search": topk_search.op2_topk_search,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_quality_classifier": quality_model.op5_quality_classifier,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_pii_surrogates": surrogates.op7_pii_surrogates,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_source_mix": curriculum.op9_source_mix,
    "op10_sentencepiece": piece_trie.op10_sentencepiece,
    "op11_simhash_near_dedup": simhash_index.op11_simhash_near_dedup,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_importance_resampling": importance.op13_importance_resampling,
}
ORACLES = {
    "op1_substring_dedup": substring_dedup.OP1_SQL,
    "op2_topk_search": topk_search.OP2_SQL,
    "op3_jaccard_join": jaccard_join.OP3_SQL,
    "op4_license_scan": license_scan.OP4_SQL,
    "op6_quality_rules": quality_rules.OP6_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op9_source_mix": curriculum.OP9_SQL,
    "op12_fill_middle": fill_middle.OP12_SQL,
    "op13_importance_resampling": importance.OP13_SQL,
}
