"""Registered queries: one for each operator, with the same result as SQL."""

from . import annotations, entrypoints, expressions, sources, utilities  # noqa: F401
from .base import ORACLE_SQL, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
