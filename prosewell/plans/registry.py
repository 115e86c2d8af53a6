"""The named queries, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# The modules of this package that register queries.
MODULES = ["text", "sentiment", "messaging", "sensing", "learning", "clustering", "auditing", "timeline", "streams"]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def values_sql(rows: list[tuple], columns: str) -> str:
    """`(VALUES ...) AS t(columns)` for an oracle."""

    def literal(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS t({columns})"
