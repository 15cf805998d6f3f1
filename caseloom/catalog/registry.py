"""Named queries over the given tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.catalog.inputs import SQL_INPUTS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, inputs: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; inputs names the derived tables its SQL selects from."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ctes = ",\n".join(f"{i} AS ({SQL_INPUTS[i]})" for i in inputs)
            ORACLES[name] = f"WITH {ctes}\n{sql}" if ctes else sql
        return fn

    return register
