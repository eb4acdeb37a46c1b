"""Chunked ingest: files of `(request_id, chunk_index, registros)` payloads, each chunk once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = ["request_id", "chunk_index"]


def payload_schema(record: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("request_id", T.StringType()),
            T.StructField("chunk_index", T.LongType()),
            T.StructField("registros", T.ArrayType(record)),
        ]
    )


def stored_schema(record: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("request_id", T.StringType()),
            T.StructField("chunk_index", T.LongType()),
            T.StructField("pos", T.IntegerType()),
            *record.fields,
            T.StructField("batch", T.LongType()),
        ]
    )


def new_chunks(payloads: DataFrame, taken: DataFrame) -> DataFrame:
    """Payloads of chunks not taken yet, with `conflicto`.

    A chunk sent twice is kept once. Copies that differ are a conflict: the one whose records hash
    lowest is kept, whatever order they came in, and the ledger says so.
    """
    digest = F.xxhash64(F.to_json("registros"))
    once = payloads.groupBy(*CHUNK).agg(
        F.min_by("registros", digest).alias("registros"), (F.min(digest) != F.max(digest)).alias("conflicto")
    )
    return once.join(taken.select(*CHUNK), CHUNK, "left_anti")


def ingest_chunks(
    spark: SparkSession,
    inbox: str,
    table: str,
    checkpoint: str,
    record: T.StructType,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Take in all waiting files, then return the table.

    Beside the table lies a ledger with one row per chunk, so a batch looks up chunks, not records,
    and nothing is kept in streaming state. A batch that is retried overwrites its own folders.
    """
    schema = stored_schema(record)
    ledger, ledger_schema = f"{table}_chunks", "request_id string, chunk_index long, conflicto boolean, batch long"
    spark.createDataFrame([], schema).write.mode("append").partitionBy("batch").parquet(table)
    spark.createDataFrame([], ledger_schema).write.mode("append").partitionBy("batch").parquet(ledger)

    def store(batch: DataFrame, number: int) -> None:
        taken = spark.read.schema(ledger_schema).parquet(ledger).where(F.col("batch") != number)
        fresh = new_chunks(batch, taken)
        rows = fresh.select(*CHUNK, F.posexplode("registros").alias("pos", "r")).select(*CHUNK, "pos", "r.*")
        rows = transform(rows) if transform else rows
        rows.write.mode("overwrite").parquet(f"{table}/batch={number}")
        fresh.select(*CHUNK, "conflicto").write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    stream = spark.readStream.schema(payload_schema(record)).json(inbox)
    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(table).drop("batch")
