"""Named queries with their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use any shared common table expression by name."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return function

    return register


def cte(name: str, body: str) -> None:
    CTES[name] = body


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the common table expressions it needs, in order of definition."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    if not needed:
        return sql
    heads = ",\n".join(f"{n} as ({b})" for n, b in CTES.items() if n in needed)
    return f"with recursive {heads}\n{sql}"


def q4(column: Column) -> Column:
    """Round to four decimals by plain arithmetic, the same in both engines."""
    return F.floor(column * 10000 + 0.500001) / 10000


def q4_sql(text: str) -> str:
    return f"(floor(({text}) * 10000 + cast(0.500001 as double)) / 10000)"


def haversine_sql(lat1, lon1, lat2, lon2, radius="6371.0088") -> str:
    h = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"(cast(2 * {radius} as double) * asin(sqrt(least(cast(1 as double), greatest(cast(0 as double), {h})))))"


def big(*names: str) -> list[Column]:
    """Columns cast to bigint under their own names."""
    return [F.col(n).cast("bigint").alias(n) for n in names]
