"""The registry of the library's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("retrieval", "text", "documents", "corpus", "sessions", "planned", "assembly")


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for m in MODULES:
        import_module(f"disclosa.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return QUERIES


def oracles() -> dict[str, str]:
    _load()
    return ORACLES
