"""The operators bound to the tables of a data folder, and their DuckDB SQL."""

from __future__ import annotations

from spanlake.llm import (best_fit, decontamination, exact_dedup, filter_audit, html_text, jaccard_join, merkle, packing, secrets, suffix_dedup,
                          token_counts, token_output, toxicity)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_token_output": token_output.op5_token_output,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_html_text": html_text.op9_html_text,
    "op10_packing": packing.op10_packing,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_best_fit": best_fit.op12_best_fit,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op3_secret_scan": secrets.OP3_SQL,
    "op11_merkle_manifest": merkle.OP11_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
