"""Flattening for export, and the sinks."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.functions import text as tx
from caselog.operators import tables as tb

LIST_SEPARATOR = " | "
BOM = "\ufeff"
MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
JOINED_LIST = "elementos_faltantes"
AUDIT_LISTS = ["evidencias", "observaciones"]


def flat_audits(audits: DataFrame, separator: str = LIST_SEPARATOR) -> DataFrame:
    """Audit lists as joined text, null lists as empty text."""
    joined = {
        c: F.coalesce(F.array_join(F.col(c).cast("array<string>"), separator), F.lit(""))
        for c in AUDIT_LISTS
        if c in audits.columns
    }
    return audits.withColumns(joined) if joined else audits


def _cell(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType) and name == JOINED_LIST:
        items = F.transform(value.cast("array<string>"), tx.squeeze_strip)
        value = F.array_join(F.filter(items, lambda e: F.coalesce(e != "", F.lit(False))), LIST_SEPARATOR)
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        value = F.to_json(value, {"ignoreNullFields": "false"})
    elif isinstance(kind, T.StringType):
        value = tx.squeeze_strip(value)
    return F.coalesce(value.cast("string"), F.lit("")).alias(name)


def flat_notes(notes: DataFrame) -> DataFrame:
    """Classified notes as text cells in export order."""
    kinds = {f.name: f.dataType for f in notes.schema.fields}
    return notes.select(*[_cell(c, kinds[c]) for c in tb.export_columns(notes.columns)])


def _write_csv(df: DataFrame, path: str, mode: str) -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_audit_csv(audits: DataFrame, path: str, separator: str = LIST_SEPARATOR, mode: str = "errorifexists") -> None:
    """Flat audits as CSV; without any audit, one row that says so."""
    if audits.isEmpty():
        _write_csv(audits.sparkSession.createDataFrame([("sin registros",)], "info string"), path, mode)
    else:
        _write_csv(flat_audits(audits, separator), path, mode)


def write_notes_csv(notes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Flat notes as CSV with a byte-order mark ahead of each file's header."""
    if notes.isEmpty():
        raise ValueError("nothing to export")
    flat = flat_notes(notes)
    _write_csv(flat.withColumnRenamed(flat.columns[0], BOM + flat.columns[0]), path, mode)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One record per line. The surrounding list is not written, so files stay splittable."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def table_name(path: str) -> str:
    return tb.clean_name(os.path.splitext(os.path.basename(path.rstrip("/")))[0])


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema of a Parquet table, None where there is none yet."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as failure:
        if failure.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_table(raw: DataFrame, path: str, if_exists: str = "append", rejected_path: str | None = None) -> DataFrame:
    """Write text columns as a typed table and return its type table.

    A new table takes the types all its values have. Appending to a table keeps that table's types:
    rows with a value that does not fit go to `rejected_path` (by default beside the table) with the
    column's name as `motivo` and their text as `_texto`.
    """
    schema = stored_schema(raw.sparkSession, path) if if_exists == "append" else None
    if schema is None:
        types = tb.column_types(raw)
        tb.apply_types(raw, types).write.mode(MODES[if_exists]).parquet(path)
        return types
    fitted = tb.fit_to(raw, schema)
    fits = F.col("motivo").isNull()
    fitted.where(fits).drop("motivo", "_texto").write.mode("append").parquet(path)
    fitted.where(~fits).select("motivo", "_texto").write.mode("append").parquet(rejected_path or f"{path}_rechazos")
    rows = [(i, f.name, tb.STORED_KINDS[f.dataType.simpleString()]) for i, f in enumerate(schema.fields)]
    return raw.sparkSession.createDataFrame(rows, "posicion int, columna string, tipo string")


def write_accepted(typed: DataFrame, path: str, rejected_path: str, mode: str = "append") -> None:
    """Rows without `motivo` to the table, the others with their reason beside it."""
    typed.where(F.col("motivo").isNull()).drop("motivo").write.mode(mode).parquet(path)
    typed.where(F.col("motivo").isNotNull()).write.mode(mode).parquet(rejected_path)
