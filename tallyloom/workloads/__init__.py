"""Queries over the TPC-H-like tables, each with the SQL it must agree with.

Modules register their cases here; ``QUERIES`` maps a name to a function
``(spark, folder) -> DataFrame`` and ``ORACLES`` the same name to SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import split_methods

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            split_methods(spark)
            return query(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def load_all() -> None:
    from . import checks, loads, reconcile, shape, state, text  # noqa: F401
