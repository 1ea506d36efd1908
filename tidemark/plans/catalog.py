"""All queries of the library itself and their SQL."""

from __future__ import annotations

from tidemark.plans import learning_queries, rule_queries, series_queries, text_queries

_PARTS = (series_queries, text_queries, learning_queries, rule_queries)
QUERIES = {k: f for p in _PARTS for k, f in p.QUERIES.items()}
ORACLE_SQL = {k: s for p in _PARTS for k, s in p.ORACLE_SQL.items()}
