"""Registered queries of the training-data operators and the SQL of those that have one."""

from __future__ import annotations

from presswork.llm import (
    alignment,
    importance,
    language_id,
    licences,
    line_dedup,
    line_frequency,
    mtree,
    near_dup,
    packing,
    pii,
    quality,
    reputation,
    sentencepiece_codec,
)

MODULES = (quality, sentencepiece_codec, line_frequency, mtree, language_id, line_dedup, licences, pii, packing, near_dup, alignment, importance, reputation)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
