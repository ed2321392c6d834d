"""Registry of the engine's queries: each a function of (spark, sf_dir), with the SQL that it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


from harrow.plans import auction_queries, document_queries, quote_queries, source_queries  # noqa: E402, F401
