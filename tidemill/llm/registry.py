"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import bounded_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_bounded_batches(function):
    """A query or stage whose first argument is the session, run with bounded batches."""

    @wraps(function)
    def bounded(spark, *args):
        bounded_batches(spark)
        return function(spark, *args)

    return bounded


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL where SQL can express it."""

    def register(function):
        QUERIES[name] = with_bounded_batches(function)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
