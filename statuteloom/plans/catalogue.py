"""All registered queries and their SQL checks."""

from __future__ import annotations

from statuteloom.plans import chunk_checks, problems, review_queries, table_queries, text_queries

QUERIES = {**problems.QUERIES, **text_queries.QUERIES, **table_queries.QUERIES, **review_queries.QUERIES}
ORACLES = {**problems.ORACLES, **text_queries.ORACLES, **chunk_checks.ORACLES, **table_queries.ORACLES, **review_queries.ORACLES}
