"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from vellum.llm import (caps, chat_format, conversation_repair, decontaminate, filter_audit, language_id, minhash,
                        mixing, paragraphs, personal_data, repeats, token_counts, toxicity)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_spherical_caps": caps.op3_spherical_caps,
    "op4_mixing": mixing.op4_mixing,
    "op5_substring_dedup": paragraphs.op5_substring_dedup,
    "op6_minhash": minhash.op6_minhash,
    "op7_language_id": language_id.op7_language_id,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_chat_formatting": chat_format.op9_chat_formatting,
    "op10_repeats": repeats.op10_repeats,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_personal_data": personal_data.op12_personal_data,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLES = {
    "op1_decontamination": decontaminate.ORACLE_SQL,
    "op3_spherical_caps": caps.ORACLE_SQL,
    "op6_minhash": minhash.ORACLE_SQL,
    "op9_chat_formatting": chat_format.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op12_personal_data": personal_data.ORACLE_SQL,
    "op13_conversation_repair": conversation_repair.ORACLE_SQL,
}
