"""Queries over the given tables, one or more per operator, each beside the SQL that checks it."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are counted, and a test checks its values."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    """Fill the registry, and send the code of both packages along with the tasks that need it.

    That way the workers need no copy of the repository, wherever the driver was started from.
    """
    import temperament  # noqa: F401  registers itself

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    from registry import builders, choices, loops, metrics, ratings, rows, shapes, stores  # noqa: F401
