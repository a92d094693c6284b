"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from urbanpulse.llm.decontaminate import OP5_SQL, op5_decontamination
from urbanpulse.llm.jaccard import op2_jaccard_join, op2_jaccard_links
from urbanpulse.llm.langid import op8_language_id
from urbanpulse.llm.lemp import OP13_SQL, op13_hard_negatives
from urbanpulse.llm.licenses import op10_license_scans
from urbanpulse.llm.merkle import OP12_SQL, op12_merkle_manifest
from urbanpulse.llm.packing import op4_best_fit_packing
from urbanpulse.llm.secrets import op11_secret_scans
from urbanpulse.llm.suffixdedup import op1_suffix_dedup
from urbanpulse.llm.tokencount import op6_token_counts
from urbanpulse.llm.toxicity import op7_toxicity
from urbanpulse.llm.urls import op9_url_filters
from urbanpulse.llm.vafile import OP3_SQL, op3_exact_top_k

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op2_jaccard_links": op2_jaccard_links,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_url_filters": op9_url_filters,
    "op10_license_scans": op10_license_scans,
    "op11_secret_scans": op11_secret_scans,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_top_k": OP3_SQL,
    "op5_decontamination": OP5_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
