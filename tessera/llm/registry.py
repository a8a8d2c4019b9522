"""Queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from tessera.llm import (alignment, chat, collocations, decontamination, html_extract, language_id, minhash, mixing, packing,
                         pii, quality_model, quality_rules, token_counts)

QUERIES = {
    "op1_decontamination": decontamination.query,
    "op2_quality_rules": quality_rules.query,
    "op3_minhash_dedup": minhash.query,
    "op4_source_mixing": mixing.query,
    "op5_quality_classifier": quality_model.query,
    "op6_language_id": language_id.query,
    "op7_html_extraction": html_extract.query,
    "op8_chat_format": chat.query,
    "op9_personal_data": pii.query,
    "op10_token_counts": token_counts.query,
    "op11_phrase_collocations": collocations.query,
    "op12_tokenizer_alignment": alignment.query,
    "op13_bestfit_packing": packing.query,
}

#: The others are tested against brute force or by held-out accuracy.
ORACLES = {
    "op1_decontamination": decontamination.ORACLE_SQL,
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op3_minhash_dedup": minhash.ORACLE_SQL,
    "op8_chat_format": chat.ORACLE_SQL,
    "op11_phrase_collocations": collocations.ORACLE_SQL,
}
