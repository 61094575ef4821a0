"""Registered queries of the operators and their DuckDB SQL where SQL can
express them."""

from __future__ import annotations

from . import (oracle, op1_suffix_dedup, op2_lm_scoring, op3_quality_rules, op4_language_id, op5_source_mixing, op6_fingerprints,
               op7_url_filters, op8_quality_classifier, op9_jaccard_join, op10_best_fit_packing, op11_phrase_mining, op12_html_extraction, op13_tokenizer_alignment)

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup.query,
    "op2_lm_scoring": op2_lm_scoring.query,
    "op3_quality_rules": op3_quality_rules.query,
    "op4_language_id": op4_language_id.query,
    "op5_source_mixing": op5_source_mixing.query,
    "op6_fingerprints": op6_fingerprints.query,
    "op7_url_filters": op7_url_filters.query,
    "op8_quality_classifier": op8_quality_classifier.query,
    "op9_jaccard_join": op9_jaccard_join.query,
    "op10_best_fit_packing": op10_best_fit_packing.query,
    "op11_phrase_mining": op11_phrase_mining.query,
    "op12_html_extraction": op12_html_extraction.query,
    "op13_tokenizer_alignment": op13_tokenizer_alignment.query,
}

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op9_jaccard_join": oracle.JACCARD_JOIN,
    "op11_phrase_mining": op11_phrase_mining.ORACLE_SQL,
}
