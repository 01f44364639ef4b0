"""Register queries and their SQL; @name in SQL stands for the subquery of that name in TABLES_SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TABLES_SQL: dict[str, str] = {}

Query = Callable[["Tables"], DataFrame]


class Tables:
    """The tables of a folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def expand(sql: str) -> str:
    """SQL with all @names replaced."""
    while re.search(r"@\w+", sql):
        sql = re.sub(r"@(\w+)", lambda m: f"({TABLES_SQL[m[1]]})", sql)
    return sql


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of Tables under its own name, with SQL that gives the same rows."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put
