"""Every registered query and its DuckDB oracle, by name."""

from __future__ import annotations

from tidemark.plans import chain_queries, fact_queries, history_queries, quality_queries, warehouse_queries

QUERIES: dict = {}
ORACLE: dict = {}

for _mod in (history_queries, fact_queries, quality_queries, chain_queries, warehouse_queries):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)
