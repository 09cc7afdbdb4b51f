"""Queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from gustline.llm import (
    decontaminate, extract, language, mixing, near_join, prefix_counts, quality_rules, sharding, token_store, toxicity,
    vector_codes, warc, whitening,
)

_MODULES = (decontaminate, toxicity, warc, sharding, token_store, mixing, quality_rules, language, extract, near_join,
            vector_codes, prefix_counts, whitening)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
