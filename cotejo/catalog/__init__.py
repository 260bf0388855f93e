"""Registered queries over the star-schema tables, each with the SQL that gives the same rows."""

from cotejo.catalog import cleaning, documents, lookups, reports, snapshots, sheets  # noqa: F401
from cotejo.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
