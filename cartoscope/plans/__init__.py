"""Registered queries: each applies operators to the tables of a folder, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("detections", "joins", "aggregates", "windows", "groups", "landmarks", "pixels", "sources", "streams")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of all modules by name."""
    from cartoscope.plans.registry import QUERIES

    for m in MODULES:
        import_module(f"cartoscope.plans.{m}")
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    """Their SQL, where there is one."""
    from cartoscope.plans.registry import SQL, expand

    all_queries()
    return {k: expand(v) for k, v in SQL.items()}
