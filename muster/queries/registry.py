"""Name, Spark query and SQL twin of every registered query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from muster.queries.views import Tables

AS_OF = dt.date(2024, 2, 1)
_TABLES: dict[tuple[str, str], Tables] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _tables(spark: SparkSession, folder: str) -> Tables:
    """View definitions of a folder, analysed once per application. They hold
    plans, no rows."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, folder)
    return _TABLES[key]


def query(name: str, sql: str | None = None):
    """Register a function of the tables; ``sql`` names the views in braces."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(_tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
