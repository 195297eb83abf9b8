"""Queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from docloom.llm import chat, codecompress, htmltext, langid, licenses, mixing, packing, pqdedup, quality, secretscan, simhash, suffixmerge, tokenalign

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_secret_scan": secretscan.op2_secret_scan,
    "op3_html_text": htmltext.op3_html_text,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_embedding_near_dedup": pqdedup.op6_embedding_near_dedup,
    "op7_language_id": langid.op7_language_id,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_chat_format": chat.op10_chat_format,
    "op11_vector_codes": codecompress.op11_vector_codes,
    "op12_token_alignment": tokenalign.op12_token_alignment,
    "op13_suffix_dedup": suffixmerge.op13_suffix_dedup,
    "quality_ablation": quality.quality_ablation,
}

ORACLES: dict[str, str] = {"op2_secret_scan": secretscan.ORACLE, "op4_quality_rules": quality.ORACLE, "quality_ablation": quality.ABLATION, "op8_mix_sources": mixing.ORACLE, "op10_chat_format": chat.ORACLE}
