"""Query key to callable and oracle SQL."""

from __future__ import annotations

from . import file_queries, graph_queries, health_queries, record_queries, retrieval_queries, text_queries, theme_queries

_PARTS = (graph_queries, text_queries, retrieval_queries, theme_queries, health_queries, record_queries, file_queries)
QUERIES = {name: run for part in _PARTS for name, run in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
