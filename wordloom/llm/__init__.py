"""Operators for training corpora. Nothing outside this subpackage imports it."""

from .queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
