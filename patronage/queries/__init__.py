"""Registered queries: every operator over the sample tables, with its SQL where there is one."""

from __future__ import annotations

from . import chain, checks, dashboards, exploration, ingestion, marts, models, texts  # noqa: F401
from .registry import QUERIES, oracle_sql, queries

__all__ = ["QUERIES", "oracle_sql", "queries"]
