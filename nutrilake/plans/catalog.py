"""All registered queries (importing the modules registers them)."""
from __future__ import annotations

from nutrilake.plans import queries_cuts, queries_drift, queries_model, queries_prep, queries_state  # noqa: F401
from nutrilake.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
