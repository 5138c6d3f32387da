"""Registered queries of the core and their SQL equivalents."""

from __future__ import annotations

from . import corpus_plans, derive_plans, integrity_plans, orphan_plans, pipeline_plans, similarity_plans, text_plans

MODULES = [derive_plans, similarity_plans, integrity_plans, text_plans, corpus_plans, pipeline_plans, orphan_plans]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLES.items()}
