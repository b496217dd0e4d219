"""The registry that the query modules fill: QUERIES by name, and ORACLES, the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Length of the longest common subsequence of x and y (lists of code points): per entry of y one row of the table, whose entries are running maxima.
LCS = """list_max(list_reduce(list_prepend(list_transform(x, lambda c: 0::INT), list_transform(y, lambda c: [c])), lambda r, z:
  list_transform(range(1, len(x) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: greatest(r[i], CASE WHEN x[i] = z[1] THEN (CASE WHEN i > 1 THEN r[i - 1] ELSE 0 END) + 1 ELSE 0 END)))::INT)))"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
