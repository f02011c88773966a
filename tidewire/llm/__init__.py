"""Operators for training-data pipelines, and their registered queries."""

from __future__ import annotations

from tidewire.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
