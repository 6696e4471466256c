"""Queries and SQL of the operators in this folder."""

from __future__ import annotations

from importlib import import_module

MODULES = ("q_lm", "q_chat", "q_media", "q_lines", "q_quality", "q_shards", "q_jaccard", "q_decontaminate", "q_bpe", "q_langid", "q_infill", "q_divergence", "q_private")


def queries() -> dict:
    found = {}
    for name in MODULES:
        found |= import_module(f"{__package__}.{name}").QUERIES
    import corpus_pipeline

    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    found = {}
    for name in MODULES:
        found |= import_module(f"{__package__}.{name}").SQL
    return found
