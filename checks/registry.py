"""Registry of queries and their reference SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.session import configure
from checks.fixtures import FIXTURES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CTES: dict[str, str] = dict(FIXTURES)

AS_OF = "(select max(ts) from events)"


def rnd(expression: str, digits: int) -> str:
    """Decimal rounding in reference SQL, of sums and averages."""
    return f"cast(round(cast({expression} as decimal(28,6)), {digits}) as double)"


def rnd_once(expression: str, digits: int) -> str:
    """Decimal rounding of a single value in reference SQL, of the decimal form of a double."""
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38,15)), {digits}) as double)"


def with_ctes(sql: str) -> str:
    """Prefix a statement with the views it uses, in order of need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in needed) + "\n" + sql


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as plain UTC times, which read the same in every client."""
    times = [n for n, t in df.dtypes if t == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in times}) if times else df


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame, with its SQL if there is one.

    Views the SQL uses are added when all modules are loaded, see :func:`oracles`.
    """

    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain_times(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def oracles() -> dict[str, str]:
    """Reference SQL of every query that has one, complete with its views."""
    return {name: with_ctes(sql) for name, sql in ORACLES.items()}
