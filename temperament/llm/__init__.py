"""Operators for preparing training data at scale, and their registered queries."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage; without SQL a test holds it against a brute-force version."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    """Fill the registry of this subpackage."""
    from temperament.llm import corpus_queries, queries  # noqa: F401
