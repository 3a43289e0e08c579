"""All registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from carelake.llm import (
    queries_mixing,
    queries_native,
    queries_near,
    queries_passages,
    queries_phrases,
    queries_quality,
    queries_resampling,
    queries_tokens,
)

_MODULES = (queries_mixing, queries_native, queries_near, queries_passages, queries_phrases, queries_quality, queries_resampling, queries_tokens)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
CHECKS = {name: sql for module in _MODULES for name, sql in getattr(module, "CHECKS", {}).items()}
