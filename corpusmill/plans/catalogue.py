"""All core queries and their SQL."""

from __future__ import annotations

from corpusmill.plans import chunk_queries, link_queries, log_queries, page_queries, problems, text_queries

MODULES = [link_queries, log_queries, text_queries, chunk_queries, page_queries, problems]
FLAGSHIP = "chunk_full"


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict:
    return {k: sql for m in MODULES for k, sql in m.ORACLES.items()}
