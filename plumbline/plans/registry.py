"""Queries by name, each with the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.plans.inputs import Inputs, duckdb_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of :class:`Inputs` as a query of (session, folder)."""
    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if oracle is not None:
            ORACLES[name] = duckdb_sql(oracle)
        return build

    return register


# SQL counterparts, written as plain joins over the views

def sql_diff(expected: str, actual: str, keys, fields=(), where: str = "") -> str:
    """Count of full-outer-join rows that differ."""
    on = " AND ".join(f"e.{k} = a.{k}" for k in keys)
    alone = f"e.{keys[0]} IS NULL OR a.{keys[0]} IS NULL"
    changed = "".join(f" OR e.{f} IS DISTINCT FROM a.{f}" for f in fields)
    return f"(SELECT COUNT(*) FROM {expected} e FULL OUTER JOIN {actual} a ON {on} WHERE {alone}{changed}{where})"


def sql_duplicates(table: str, keys) -> str:
    columns = ", ".join(keys)
    return f"(SELECT COUNT(*) FROM (SELECT {columns} FROM {table} GROUP BY {columns} HAVING COUNT(*) > 1) repeated)"


def sql_count(table: str, condition: str) -> str:
    return f"(SELECT COUNT(*) FROM {table} WHERE {condition})"


def sql_totals(parts: dict[str, str], prefix: str = "") -> str:
    """Named counts and their sum, as the checks report them."""
    inner = ", ".join(f"CAST({sql} AS BIGINT) AS {name}" for name, sql in parts.items())
    total = " + ".join(parts)
    return f"{prefix}SELECT *, CAST({total} AS BIGINT) AS violation_count FROM (SELECT {inner}) counted"
