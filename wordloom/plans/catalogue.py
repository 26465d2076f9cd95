"""All queries of the library, by name."""

from __future__ import annotations

from . import audit_queries, cohort_queries, contract_queries, geometry_queries, integrity_queries, lifecycle_queries, python_queries, rater_queries, record_queries, run_queries, selection_queries, source_queries, text_queries  # noqa: F401  they register themselves
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
