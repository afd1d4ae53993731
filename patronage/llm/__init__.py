"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from __future__ import annotations

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
