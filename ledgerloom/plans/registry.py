"""Registered queries, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.fixtures import Tables
from ledgerloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; without SQL the query is checked by tests alone."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(tune(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register
