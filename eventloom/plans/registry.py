"""Queries over the given tables and the SQL that they are compared with."""

from __future__ import annotations

from . import event_queries, market_queries, master_queries, quality_queries, scan_queries, source_queries, store_queries, structured_queries

MODULES = (market_queries, event_queries, master_queries, structured_queries, store_queries, quality_queries, source_queries, scan_queries)
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _m in MODULES:
    QUERIES |= _m.QUERIES
    ORACLE_SQL |= _m.ORACLE_SQL
