"""Table jobs: shards, chunk summaries, distribution, type inference and keyed upsert."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.functions import dates as dt
from caselog.functions import numbers as nb
from caselog.functions import text as tx
from caselog.operators import skew
from caselog.schemas import LAST_CLASS, UPSERT_KEY

# Preferred order of exported note columns.
EXPORT_ORDER = [
    "nit_taller",
    "nombre_taller",
    "numero_aviso",
    "numero_siniestro",
    "placa",
    "fecha_observacion",
    "usuario",
    "rol_analista",
    "observacion",
    "clasificacion",
    "explicacion",
    "confianza",
    "explicacion_clasificacion",
    "confianza_clasificacion",
    "calidad_comunicativa_score",
    "explicacion_calidad",
    "elementos_faltantes",
]
TRUTH = r"(?i)^(true|false|t|f|yes|no|y|n|1|0)$"
WHOLE = r"^[+-]?\d+(_\d+)*$"
DATE_LIKE = r"^\d{1,4}[-/]\d{1,2}[-/]\d{1,4}"
TIME_OF_DAY = r"^([01]?\d|2[0-3]):[0-5]?\d(:([0-5]?\d|6[01]))?$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2})?)?([+-]\d{2}:?\d{2})?)?$"


def shards(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """Contiguous, equally sized slices of a total order; the last ones may stay empty."""
    placed, total = skew.ordinal(df, order)
    size = max(1, math.ceil(total / count))
    return placed.withColumn("shard_id", F.floor(F.col("ordinal") / F.lit(size)))


def chunk_size(total: int, workers: int = 1, chunksize: int = 0) -> int:
    if chunksize <= 0:
        return max(1, math.ceil(total / workers))
    return min(max(1, chunksize), total)


def chunk_summary(
    df: DataFrame, order: list[str], label: str, classes: list[str], workers: int = 1, chunksize: int = 0
) -> DataFrame:
    """chunk, desde, hasta, filas and one count per class, chunks taken in the total order."""
    placed, total = skew.ordinal(df.select(*order, label), order)
    if total == 0:
        size = 1
    else:
        size = chunk_size(total, workers, chunksize)
    chunk = F.floor(F.col("ordinal") / F.lit(size)).alias("chunk")
    named = F.coalesce(F.col(label), F.lit(LAST_CLASS))
    return placed.groupBy(chunk).agg(
        F.min("ordinal").alias("desde"),
        (F.max("ordinal") + 1).alias("hasta"),
        F.count(F.lit(1)).alias("filas"),
        *[F.count_if(named == c).alias(c) for c in classes],
    )


def class_distribution(df: DataFrame, label: str = "clasificacion") -> DataFrame:
    named = F.coalesce(F.col(label), F.lit(LAST_CLASS)).alias("clasificacion")
    return df.groupBy(named).agg(F.count(F.lit(1)).alias("registros"))


def head_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n rows of a total order."""
    return df.orderBy(*order).limit(n)


def union_all_keys(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames over the union of their columns, in export order."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*export_columns(merged.columns))


def export_columns(columns: list[str]) -> list[str]:
    preferred = [c for c in EXPORT_ORDER if c in columns]
    return preferred + sorted(c for c in columns if c not in preferred)


def clean_name(name: str) -> str:
    """Lower-case words joined by underscores; a leading digit gets a prefix, no word at all a name."""
    words = [word for word in re.split(r"[\W_]+", name.lower()) if word]
    if words and words[0][0].isdigit():
        words.insert(0, "col")
    return "_".join(words) or "col"


def unique_names(names: list[str]) -> Iterator[str]:
    """Repeated names are numbered from 2, past numbers that are already names."""
    given, last = set(), Counter()
    for name in names:
        fresh = name
        while fresh in given:
            last[name] = max(last[name], 1) + 1
            fresh = f"{name}_{last[name]}"
        given.add(fresh)
        yield fresh


def clean_names(columns: list[str]) -> list[str]:
    return list(unique_names([clean_name(c) for c in columns]))


def _is_date(value: Column) -> Column:
    """Of text that starts like a date. No such format has a colon."""
    read = dt.parse_first(value, dt.FORMATS["column_date"])
    return F.coalesce(F.when(~value.contains(":"), read.isNotNull()), F.lit(False))


def _is_timestamp(value: Column) -> Column:
    """Of text that starts like a date. Every listed format has a colon; the ISO form may do without."""
    read = F.when(value.contains(":"), dt.parse_first(value, dt.FORMATS["column_timestamp"]))
    iso = F.regexp_replace(F.replace(value, F.lit("Z"), F.lit("")), r"\..*$", "")
    clock = F.coalesce(F.nullif(F.substring(F.replace(iso, F.lit("T"), F.lit(" ")), 1, 19), F.lit("")), F.lit(""))
    flexible = iso.rlike(ISO_TIME) & F.to_date(F.substring(clock, 1, 10).try_cast("timestamp")).isNotNull()
    return F.coalesce(read.isNotNull() | flexible, F.lit(False))


def column_types(df: DataFrame) -> DataFrame:
    """posicion, columna, tipo of text columns, one aggregation pass over all rows of all columns."""
    names = clean_names(df.columns)
    text = df.toDF(*names).select(
        *[F.nullif(tx.strip_cell(F.col(f"`{n}`").cast("string")), F.lit("")).alias(n) for n in names]
    )
    return _types_of(text, names, 0)


# One bit per type a value may have; a column has the types all its values share.
INT, REAL, BOOL, DATE, TIME, STAMP, SMALL, LONG = (1 << i for i in range(8))


#: From this code point on no text starts a number, date or time, except inf and nan.
AFTER_DIGITS = ord("9") + 1


def _size_bits(digits: Column) -> Column:
    """SMALL and LONG of a whole number as text; a cast that fails costs more than all other tests."""
    bare = F.regexp_replace(digits, "^[+-]?0*", "")
    wide = F.length(digits) > 18
    number = F.when(~wide, digits.try_cast("long"))
    exact = F.when(wide & (F.length(bare) <= 19), digits.try_cast("decimal(38,0)"))
    return (
        F.when((F.length(digits) <= 9) | number.between(-(2**31), 2**31 - 1), SMALL | LONG)
        .when(~wide, LONG)
        .when(exact.between(-(2**31), 2**31 - 1), SMALL | LONG)
        .when(exact.between(-(2**63), 2**63 - 1), LONG)
        .otherwise(0)
    )


def _type_bits(value: Column) -> Column:
    """Bits of the types the text can be read as. The shapes exclude each other, so the first match decides;
    cheap tests come first, as each pattern costs more than all of them."""
    digits = F.replace(value, F.lit("_"), F.lit(""))
    whole = F.lit(INT | REAL) + F.when(value.isin("0", "1"), BOOL).otherwise(0) + _size_bits(digits)
    dated = F.when(_is_date(value), DATE).otherwise(0) + F.when(_is_timestamp(value), STAMP).otherwise(0)
    start = F.ascii(value)
    inf_or_nan = start.isin(*map(ord, "iInN")) & value.rlike(nb.NUMBER)
    word = F.when(inf_or_nan, REAL).when(value.rlike(TRUTH), BOOL).otherwise(0)
    plain = F.when(value.contains("_"), F.regexp_replace(value, r"(?<=\d)_(?=\d)", "")).otherwise(value)
    bits = (
        F.when(start >= AFTER_DIGITS, word)
        .when(value.rlike(WHOLE), whole)
        .when(value.rlike(DATE_LIKE), dated)
        .when(value.contains(":"), F.when(value.rlike(TIME_OF_DAY), TIME).otherwise(0))
        .when(plain.rlike(nb.NUMBER), REAL)
        .otherwise(0)
    )
    return F.when(value.isNotNull(), bits)


def _types_of(text: DataFrame, names: list[str], start: int) -> DataFrame:
    # Bits are worked out in their own projection: inside the aggregate they would be repeated per
    # use and grow into one method too large for the JIT.
    bits = text.select(*[tx.let(F.col(n), _type_bits).alias(f"b{i}") for i, n in enumerate(names)])
    row = bits.agg(*[F.bit_and(f"b{i}").alias(f"c{i}") for i in range(len(names))])

    def ladder(bits: Column) -> Column:
        has = lambda bit: bits.bitwiseAND(F.lit(bit)) > 0
        return (
            F.when(bits.isNull(), "TEXT")
            .when(has(INT) & has(SMALL), "INTEGER")
            .when(has(INT) & has(LONG), "BIGINT")
            .when(has(INT), "TEXT")
            .when(has(REAL), "DOUBLE PRECISION")
            .when(has(BOOL), "BOOLEAN")
            .when(has(DATE), "DATE")
            .when(has(TIME), "TIME")
            .when(has(STAMP), "TIMESTAMP")
            .otherwise(F.lit("TEXT"))
        )

    items = F.array(
        *[
            F.struct(
                F.lit(start + i).alias("posicion"),
                F.lit(name).alias("columna"),
                ladder(F.col(f"c{i}")).alias("tipo"),
            )
            for i, name in enumerate(names)
        ]
    )
    return row.select(F.explode(items).alias("t")).select("t.*")


def _bare(raw: Column, kind: str, strip: Callable[[Column], Column] = tx.strip_blank) -> Column:
    """The cell as it is read: text as given, all else without blanks around it."""
    return raw if kind == "TEXT" else F.nullif(strip(raw), F.lit(""))


def _typed(value: Column, kind: str) -> Column:
    """The bare cell as its column's type; null where it does not fit."""
    digits = F.replace(value, F.lit("_"), F.lit(""))
    return {
        "INTEGER": digits.try_cast("int"),
        "BIGINT": digits.try_cast("long"),
        "DOUBLE PRECISION": digits.try_cast("double"),
        "BOOLEAN": F.when(value.rlike(TRUTH), value.rlike(r"(?i)^(true|t|yes|y|1)$")),
        "DATE": dt.parse_first(value, dt.FORMATS["column_date"]).cast("date"),
        "TIMESTAMP": F.coalesce(dt.parse_first(value, dt.FORMATS["column_timestamp"]), value.try_cast("timestamp")),
    }.get(kind, value)


def apply_types(df: DataFrame, types: DataFrame) -> DataFrame:
    """Typed columns under their clean names. The type table has one row per column."""
    found = {r["posicion"]: (r["columna"], r["tipo"]) for r in types.collect()}
    named = [found[i] for i in range(len(df.columns))]
    text = df.toDF(*[name for name, _kind in named])
    # Cells are stripped in their own projection, as formats mention them many times.
    bare = text.select(*[_bare(F.col(name).cast("string"), kind, tx.strip_cell).alias(name) for name, kind in named])
    return bare.select(*[_typed(F.col(name), kind).alias(name) for name, kind in named])


STORED_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE PRECISION",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "string": "TEXT",
}


def fit_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in a stored table's columns and types, with `motivo`: the first column that does not fit.

    Columns are matched by their clean names; one the table has and the rows lack is null. Rows keep
    their given text in `_texto` for the rejected table.
    """
    names = clean_names(df.columns)
    unknown = [n for n in names if n not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    text = df.toDF(*names).select(*[F.col(n).cast("string").alias(n) for n in names])
    values, misfits = [], []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        if field.name not in names:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        typed = _typed(_bare(F.col(field.name), STORED_KINDS[kind]), STORED_KINDS[kind])
        values.append(typed.alias(field.name))
        misfits.append(F.when(~tx.is_blank(F.col(field.name)) & typed.isNull(), F.lit(field.name)))
    return text.select(*values, F.coalesce(*misfits).alias("motivo"), F.to_json(F.struct(*names)).alias("_texto"))


def last_arrivals(source: DataFrame, key: list[str], arrival: str) -> DataFrame:
    """One row per key, the last to arrive, with the number of copies seen."""
    rest = [c for c in source.columns if c not in [*key, arrival]]
    last = source.groupBy(*key).agg(
        F.max_by(F.struct(*rest), arrival).alias("_last"), F.count(F.lit(1)).alias("copias")
    )
    return last.select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest], "copias")


def upsert(target: DataFrame, source: DataFrame, arrival: str, key: list[str] = UPSERT_KEY) -> DataFrame:
    """New version of the target with `accion` per row: igual, actualizada or insertada.

    Keys are required fields. Both sides hold each key once, so the single join cannot skew.
    """
    columns = target.columns
    latest = last_arrivals(source, key, arrival)
    values = [c for c in columns if c not in key]
    old = target.select(*key, F.struct(*values, F.lit(True).alias("_in")).alias("_old"))
    new = latest.select(*key, F.struct(*values, F.lit(True).alias("_in")).alias("_new"), "copias")
    both = old.join(new, key, "full")
    action = (
        F.when(F.col("_new").isNull(), "igual")
        .when(F.col("_old").isNull(), "insertada")
        .otherwise(F.lit("actualizada"))
    )
    pick = F.coalesce("_new", "_old")
    shaped = both.withColumn("_v", pick).select(
        *key, *[F.col(f"_v.{c}").alias(c) for c in values], action.alias("accion"), "copias"
    )
    return shaped.select(*columns, "accion", F.coalesce("copias", F.lit(0)).alias("copias"))


def upsert_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("accion").agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.col("copias") > 1).alias("con_duplicados")
    )
