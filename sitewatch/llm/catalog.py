"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from sitewatch.llm import (q_audit, q_dedup, q_html, q_mixing, q_models, q_rules, q_search,
                            q_secrets, q_tokens)

_MODULES = (q_rules, q_secrets, q_models, q_html, q_dedup, q_search, q_tokens, q_mixing, q_audit)


def queries() -> dict:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
