"""Registered queries: a Spark program per operator and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def load_all() -> None:
    """Import every catalogue module, which registers its queries."""
    import importlib
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")


MODULES = ["components", "pixels", "labelling", "tables", "learning", "geometry", "streams", "corpora"]
