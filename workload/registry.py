"""Query name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = key
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register
