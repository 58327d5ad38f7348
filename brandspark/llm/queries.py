"""The queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import conversation_repair, embedding_dedup, html_extract, language_id, license_scan, line_dedup, mixing, ngram_join, packing, quality_mil, quality_rules, suffix_dedup, target_resampling

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_quality_rules": quality_rules.query,
    "op3_line_dedup": line_dedup.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_quality_mil": quality_mil.query,
    "op6_packing": packing.query,
    "op7_ngram_join": ngram_join.query,
    "op8_embedding_dedup": embedding_dedup.query,
    "op9_license_scan": license_scan.query,
    "op10_mixing": mixing.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_target_resampling": target_resampling.query,
    "op13_html_extract": html_extract.query,
}

ORACLES: dict[str, str] = {"op3_line_dedup": line_dedup.ORACLE, "op12_target_resampling": target_resampling.ORACLE}
