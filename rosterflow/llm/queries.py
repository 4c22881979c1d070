"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from rosterflow.llm import cotraining, decontaminate, filter_audit, jaccard_join, language_id, line_dedup, lm_score, pieces, quality_rules, token_ids, toxicity, url_filter, whitening

QUERIES = {
    "op1_cross_parsing": language_id.op1_cross_parsing,
    "op2_stupid_backoff": lm_score.op2_stupid_backoff,
    "op3_redirect_equivalence": url_filter.op3_redirect_equivalence,
    "op4_co_training": cotraining.op4_co_training,
    "op5_shingle_components": jaccard_join.op5_shingle_components,
    "op6_repetition_rules": quality_rules.op6_repetition_rules,
    "op7_simple8b": token_ids.op7_simple8b,
    "op8_classifier_chain": toxicity.op8_classifier_chain,
    "op9_benchmark_windows": decontaminate.op9_benchmark_windows,
    "op10_sentencepiece": pieces.op10_sentencepiece,
    "op11_shifted_cholesky_qr": whitening.op11_shifted_cholesky_qr,
    "op12_existential_copies": filter_audit.op12_existential_copies,
    "op13_line_blooms": line_dedup.op13_line_blooms,
}
ORACLES = {
    "op2_stupid_backoff": lm_score.SQL,
    "op3_redirect_equivalence": url_filter.SQL,
    "op5_shingle_components": jaccard_join.SQL,
    "op6_repetition_rules": quality_rules.SQL,
    "op9_benchmark_windows": decontaminate.SQL,
    "op12_existential_copies": filter_audit.SQL,
    "op13_line_blooms": line_dedup.SQL,
}
