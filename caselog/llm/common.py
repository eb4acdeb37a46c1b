"""Helpers the corpus operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL twin where there is one."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def by_batch(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Maps Arrow batches one by one; the function returns a batch of the given schema, or nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = function(batch)
            if result is not None and result.num_rows:
                yield result

    return df.mapInArrow(run, schema)


def extra_name(df: DataFrame, stem: str) -> str:
    """A column name the frame does not have yet."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def per_process(slot: str, name: str, make: Callable[[], object]) -> object:
    """A value that outlives the task in a Python worker that Spark uses again; one per slot.

    Worker functions travel by value, so module globals would start afresh with every task. A value of
    another name takes the slot, so that models of earlier jobs are not kept.
    """
    kept = sys.modules.setdefault("_caselog_worker_values", types.ModuleType("_caselog_worker_values"))
    if getattr(kept, slot, (None,))[0] != name:
        setattr(kept, slot, (None,))
        setattr(kept, slot, (name, make()))
    return getattr(kept, slot)[1]
