"""All registered queries over the driver tables, and SQL for each where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with equivalent SQL for the same tables."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


from lectern.plans import array_queries, check_queries, join_queries, report_queries, sequence_queries, text_queries, udf_queries  # noqa: E402, F401
