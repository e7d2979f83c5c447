"""The registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from tickweave.llm import chat, decontam, exact_dedup, licenses, negatives, pieces, quality, quality_rules, resample, simhash, substrings, token_ids, warc

QUERIES = {
    "op1_decontamination": decontam.op1_decontamination,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_suffix_array_dedup": substrings.op3_suffix_array_dedup,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_warc": warc.op6_warc,
    "op7_simhash": simhash.op7_simhash,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_token_ids": token_ids.op9_token_ids,
    "op10_license_scans": licenses.op10_license_scans,
    "op11_importance_resampling": resample.op11_importance_resampling,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_quality_rules": quality_rules.op13_quality_rules,
}
ORACLE_SQL = {
    "op1_decontamination": decontam.OP1_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op6_warc": warc.OP6_SQL,
    "op8_chat_formatting": chat.OP8_SQL,
    "op11_importance_resampling": resample.OP11_SQL,
    "op12_hard_negatives": negatives.OP12_SQL,
}
