"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from importlib import import_module

#: Query, its module and its function. A module may hold ``ORACLE``, SQL with the same rows.
PLACES = {
    "op1_suffix_dedup": ("repeats", "suffix_dedup"),
    "op2_ngram_jaccard": ("jaccard", "ngram_jaccard"),
    "op3_license_scan": ("licenses", "license_scan"),
    "op4_quality_rules": ("quality", "quality_rules"),
    "op5_lm_scores": ("deleted", "lm_scores"),
    "op6_html_extraction": ("html", "html_extraction"),
    "op7_packing": ("packing", "packed_documents"),
    "op8_language_id": ("language", "language_id"),
    "op9_byte_bpe": ("bpe", "byte_bpe"),
    "op10_embedding_near_duplicates": ("embeddings", "embedding_near_duplicates"),
    "op11_url_filter": ("reputation", "url_filter"),
    "op12_token_alignment": ("alignment", "token_alignment"),
    "op13_importance_resampling": ("resampling", "importance_resampling"),
}

QUERIES = {name: getattr(import_module(f"urlaudit.llm.{module}"), function) for name, (module, function) in PLACES.items()}
ORACLES = {name: sql for name, (module, _) in PLACES.items() if (sql := getattr(import_module(f"urlaudit.llm.{module}"), "ORACLE", None))}
