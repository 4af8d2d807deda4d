"""Registered queries over the standard tables, each with the SQL it must
agree with where SQL can say the same."""

from ledgerleaf.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
