"""Registry of the queries and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The test tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function over ``Tables`` under a name, with its SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def day(c: Column | str) -> Column:
    """ISO text of a date or timestamp's day."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date").cast("string")


def micros(c: str) -> Column:
    """Microseconds since the epoch of a zone-less or zoned timestamp (session zone UTC)."""
    return F.unix_micros(F.col(c).cast("timestamp"))
