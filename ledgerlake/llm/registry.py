"""Queries of this subpackage and their DuckDB oracles (None: not expressible)."""

from __future__ import annotations

from ledgerlake.llm import dedup_exact, lexical, licenses, mixing, near_dedup, pii, quality, rules, secrets, sharding, spelling, tokens, winnowing

QUERIES = {
    "op1_decontamination": (winnowing.op1_decontamination, winnowing.OP1_SQL),
    "op2_mixing": (mixing.op2_mixing, None),
    "op3_license_scan": (licenses.op3_license_scan, licenses.OP3_SQL),
    "op4_sharding": (sharding.op4_sharding, None),
    "op5_quality": (quality.op5_quality, None),
    "op6_exact_dedup": (dedup_exact.op6_exact_dedup, dedup_exact.OP6_SQL),
    "op7_token_output": (tokens.op7_token_output, None),
    "op8_secrets": (secrets.op8_secrets, None),
    "op9_pii": (pii.op9_pii, None),
    "op10_near_dedup": (near_dedup.op10_near_dedup, near_dedup.OP10_SQL),
    "op11_lexical_search": (lexical.op11_lexical_search, lexical.OP11_SQL),
    "op12_quality_rules": (rules.op12_quality_rules, None),
    "op13_spelling": (spelling.op13_spelling, spelling.OP13_SQL),
}
