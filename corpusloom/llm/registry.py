"""Registered queries of the training-data operators and their SQL equivalents."""

from __future__ import annotations

from . import plans


def queries() -> dict:
    return dict(plans.QUERIES)


def oracle_sql() -> dict:
    return dict(plans.ORACLES)
