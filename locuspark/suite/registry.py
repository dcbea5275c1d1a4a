"""The query registry: a name, a DataFrame query and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locuspark.suite.domain import Domain, with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(domain) -> DataFrame`` with an oracle over the domain tables."""

    def keep(fn: Callable[[Domain], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Domain(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return keep
