"""Registered queries, each next to the SQL it is checked against."""

from __future__ import annotations

from stratiform.catalog import checks, documents, layers, mutations, profiles, storage, stored, streams  # noqa: F401
from stratiform.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
