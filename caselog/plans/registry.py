"""Registered queries: a Spark callable per name and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when a table has fewer splits than there are cores.

    For steps with much work per row. A table of many files is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


DEALT_ROWS = 200_000


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key to one task per core, or to so many that each has about DEALT_ROWS of them.

    For steps that put a task's rows in order: their memory grows with the rows of a task, and a split
    of a narrow table may hold millions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, math.ceil(df.count() / DEALT_ROWS)), key)
