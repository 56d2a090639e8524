"""Registration of queries, and what they share.

Queries run over whole tables. Where an operator takes a second table that the driver's data lacks (a history, what was
processed), the residue of an id derives it, and page numbers, boxes or log lines are derived by integer arithmetic that both
engines compute alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add
