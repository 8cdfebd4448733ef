"""All registered queries (one per operator of SURVEY section 2)."""

from __future__ import annotations

import importlib

from tidewatch.plans.common import ORACLE, QUERIES

_MODULES = (
    "tidewatch.plans.expr_queries",
    "tidewatch.plans.metric_queries",
    "tidewatch.plans.etl_queries",
    "tidewatch.plans.lineage_queries",
    "tidewatch.plans.monitor_queries",
    "tidewatch.plans.source_queries",
    "tidewatch.plans.stream_queries",
)


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLE)
