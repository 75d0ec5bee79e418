"""All queries of the subpackage and their SQL."""

from __future__ import annotations

from corpusmill.llm import queries as problem_queries

MODULES = [problem_queries]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict:
    return {k: sql for m in MODULES for k, sql in m.ORACLES.items()}
