"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = lambda spark, sf_dir: function(utc(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(value: str | Column, digits: int) -> Column:
    """Rounded with ties falling one way, whatever the order of summation; the SQL does the same."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column + 10.0 ** -(digits + 3), digits)
