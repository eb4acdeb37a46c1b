"""Reading note files and record envelopes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.schemas import REQUIRED_NOTE_COLUMN


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below a path, grouped by their header line.

    Only first lines reach the driver, one per header; it holds the names of the files, as any reader does.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    heads = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("head"))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [row["files"] for row in groups.orderBy("head").collect()]


def read_note_csv(
    spark: SparkSession,
    path: str,
    required: list[str] = (REQUIRED_NOTE_COLUMN,),
    delimiter: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = True,
    same_header: bool = False,
) -> DataFrame:
    """Header CSV, every column text. A file without a required column is refused.

    Files of a folder are read by column name: files of different headers are united, and a column
    that some lack is null there. `same_header=True` saves looking at the headers first; a file whose
    header differs then fails. Notes may hold line breaks, so a file is read by one task: keep files
    below about 1 GB, or turn `multi_line` off where notes are single lines and files can be split.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )
    groups = [path] if same_header else header_groups(spark, path)
    frames = [reader.csv(files) for files in (groups if len(groups) > 1 else [path])]
    for frame in frames:
        absent = [c for c in required if c not in frame.columns]
        if absent:
            raise ValueError(f"{path} lacks required columns {absent}")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_registros(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records of `{"registros": [...]}` or of a bare list; any other document gives no rows.

    A document is read whole by one task. Convert large ones once with `write_json_lines`.
    """
    schema = T.StructType([T.StructField("registros", T.ArrayType(record)), *record.fields])
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    own = F.struct(*[F.col(f.name) for f in record.fields])
    any_value = F.coalesce(*[F.col(f.name).isNotNull() & F.lit(True) for f in record.fields])
    for field in record.fields:
        any_value = any_value | F.col(field.name).isNotNull()
    rows = F.when(F.col("registros").isNotNull(), F.col("registros")).when(any_value, F.array(own))
    return docs.select(F.explode(rows).alias("r")).select("r.*")


def read_json_lines(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    return spark.read.schema(record).json(path)
