"""Registration of named queries with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamarack.functions.text import WS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name; ``oracle`` is DuckDB SQL with the same columns."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def strip_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"


def words_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda w: w <> '')"


def squash_sql(c: str) -> str:
    return f"array_to_string({words_sql(f'coalesce({c}, chr(0)[2:])')}, ' ')".replace("chr(0)[2:]", "''")


def keyed_sql(seed, c: str) -> str:
    return f"sha256(concat('{seed}', chr(31), CAST({c} AS VARCHAR)))"


def literal(v) -> str:
    """A SQL literal that both engines read."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"


def duck_rows(name: str, columns: str, rows: list[tuple]) -> str:
    """A CTE of typed literal rows for DuckDB; ``columns`` are ``name TYPE`` pairs."""
    pairs = [c.strip().split(" ") for c in columns.split(",")]
    picked = ", ".join(f"CAST(c{i} AS {t}) AS {n}" for i, (n, t) in enumerate(pairs))
    values = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return f"{name} AS (SELECT {picked} FROM (VALUES {values}) AS v({', '.join(f'c{i}' for i in range(len(pairs)))}))"
