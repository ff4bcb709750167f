from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

FAMILY_MODULES = [
    "auditlens.plans.q_labels", "auditlens.plans.q_features",
    "auditlens.plans.q_metrics", "auditlens.plans.q_fairness", "auditlens.plans.q_calibration",
    "auditlens.plans.q_explain", "auditlens.plans.q_models", "auditlens.plans.q_monitoring",
    "auditlens.plans.q_streaming", "auditlens.plans.q_survival",
]


def query(key: str, sql: str | None = None):
    """Register a query callable (and its oracle SQL when given)."""

    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every family; one that is missing or broken is an error."""
    for m in FAMILY_MODULES:
        importlib.import_module(m)
