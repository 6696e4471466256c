"""All queries over the reference's operators, and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("q_metrics", "q_profile", "q_flow", "q_code", "q_recovery", "q_git", "q_sources")


def queries() -> dict:
    found = {}
    for name in MODULES:
        found |= import_module(f"lintel.plans.{name}").QUERIES
    return found


def oracle_sql() -> dict:
    found = {}
    for name in MODULES:
        found |= import_module(f"lintel.plans.{name}").SQL
    return found
