"""Registered queries with their SQL twins."""

from __future__ import annotations

from tidewire.catalog import ingest, market, serving, social, streams

MODULES = (ingest, market, social, serving, streams)


def all_queries() -> dict:
    return {key: query for module in MODULES for key, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {key: sql for module in MODULES for key, sql in module.SQL.items()}
