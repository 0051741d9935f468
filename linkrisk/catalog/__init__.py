"""Registered queries: every operator over the given tables, with equivalent SQL."""

from linkrisk.catalog.base import QUERIES, SQL
from linkrisk.catalog import (  # noqa: F401
    relational,
    landed,
    features,
    splitting,
    evaluation,
    domains,
    attempts,
    learning,
    compositions,
)

__all__ = ["QUERIES", "SQL"]
