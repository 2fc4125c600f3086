"""Named queries over the test tables, each with its SQL twin where SQL can express it."""

from tidemark.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
