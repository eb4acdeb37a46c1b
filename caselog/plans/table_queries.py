"""Sources, sinks, profiling, shards, upsert and chunked ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.operators import notes as nt
from caselog.operators import tables as tb
from caselog.plans import sqlbits as sb
from caselog.plans.case_queries import RECORDS_SQL, records
from caselog.plans.inputs import NOTES_SQL, notes
from caselog.plans.registry import query, spread, table
from caselog.schemas import UPSERT_KEY
from caselog.session import shared_path
from caselog.sources import readers, writers
from caselog.streaming import ingest

_TRICKY = "CASE WHEN ord % 3 = 0 THEN 'dijo \"no\", ' || chr(10) || observacion ELSE observacion END"


@query(
    "note_csv_source",
    f"SELECT ord, nombre_taller, placa, {_TRICKY} AS observacion FROM ({NOTES_SQL})",
)
def note_csv_source(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "notes-csv")
    rows = notes(spark, folder).selectExpr(
        "CAST(ord AS STRING) AS ord", "nombre_taller AS `NOMBRE TALLER`", "placa AS PLACA", f"{_TRICKY} AS OBSERVACION"
    )
    (
        rows.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    read = readers.read_note_csv(spark, path)
    return read.select(
        F.col("ord").cast("long").alias("ord"),
        F.col("NOMBRE TALLER").alias("nombre_taller"),
        F.col("PLACA").alias("placa"),
        F.col("OBSERVACION").alias("observacion"),
    )


@query(
    "note_csv_mixed_headers",
    "SELECT ord, nombre_taller, CASE WHEN ord % 3 < 2 THEN placa END AS placa, CASE WHEN ord % 3 = 2 THEN usuario END AS usuario "
    f"FROM ({NOTES_SQL})",
)
def note_csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of files whose columns come in other orders, or that lack one."""
    path = shared_path(spark, "notes-mixed")
    rows = notes(spark, folder).selectExpr(
        "CAST(ord AS STRING) AS ord", "nombre_taller AS `NOMBRE TALLER`", "placa AS PLACA", "usuario AS USUARIO", "ord % 3 AS parte"
    )
    orders = (["ord", "NOMBRE TALLER", "PLACA"], ["PLACA", "ord", "NOMBRE TALLER"], ["USUARIO", "NOMBRE TALLER", "ord"])
    for number, columns in enumerate(orders):
        part = rows.where(F.col("parte") == number).select(*columns)
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        part.write.mode("append").options(**options).csv(path)
    read = readers.read_note_csv(spark, path)
    return read.select(
        F.col("ord").cast("long").alias("ord"),
        F.col("NOMBRE TALLER").alias("nombre_taller"),
        F.col("PLACA").alias("placa"),
        F.col("USUARIO").alias("usuario"),
    )


_ENVELOPE = T.StructType(
    [T.StructField("ord", T.LongType()), T.StructField("observacion", T.StringType()), T.StructField("k", T.LongType())]
)


@query(
    "record_envelopes",
    f"SELECT ord, observacion, k FROM ({NOTES_SQL}) WHERE CAST((ord - ord % 500) / 500 AS BIGINT) % 3 < 2",
)
def record_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "envelopes")
    doc = F.expr("CAST((ord - ord % 500) / 500 AS BIGINT)")
    rows = notes(spark, folder).select(doc.alias("doc"), F.struct("ord", "observacion", "k").alias("r"))
    docs = rows.groupBy("doc").agg(F.collect_list("r").alias("registros"))
    text = (
        F.when(F.col("doc") % 3 == 0, F.to_json(F.struct("registros")))
        .when(F.col("doc") % 3 == 1, F.to_json("registros"))
        .otherwise(F.to_json(F.struct(F.col("doc").alias("otra"))))
    )
    docs.select("doc", text.alias("value")).write.partitionBy("doc").text(path)
    return readers.read_registros(spark, path, _ENVELOPE)


_TYPED_SOURCE = {
    "l_orderkey": "CAST(l_orderkey AS STRING)",
    "Big Key": "CAST(l_orderkey + 3000000000 AS STRING)",
    "over": "'922337203685477580' || CAST(l_linenumber AS STRING) || CAST(l_linenumber AS STRING)",
    "2nd flag": "CASE WHEN l_linenumber = 1 THEN 'yes' WHEN l_linenumber = 2 THEN ' 1 ' ELSE 'No' END",
    "l_discount": "CASE WHEN l_linenumber = 1 THEN '1' ELSE CAST(l_discount AS STRING) END",
    "l_returnflag": "l_returnflag",
    "dia": "CASE WHEN l_linenumber = 1 THEN '2024-01-31' WHEN l_linenumber = 2 THEN '31/01/2024' ELSE '' END",
    "Dia": "CASE WHEN l_linenumber = 1 THEN '08:30' ELSE '23:59:59' END",
    "sello": "CASE WHEN l_linenumber = 1 THEN '2024-01-31T08:30:00.123Z' ELSE '2024-01-31 08:30' END",
    "--": "CASE WHEN l_linenumber > 99 THEN 'x' ELSE '  ' END",
}


def _typed_source(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "lineitem")).selectExpr(*[f"{e} AS `{n}`" for n, e in _TYPED_SOURCE.items()])


_TYPE_NAMES = ["l_orderkey", "big_key", "over", "col_2nd_flag", "l_discount", "l_returnflag", "dia", "dia_2", "sello", "col"]
_LADDER = (
    "CASE WHEN count(v) = 0 THEN 'TEXT' WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+')) THEN "
    "CASE WHEN bool_and(TRY_CAST(v AS INTEGER) IS NOT NULL) THEN 'INTEGER' WHEN bool_and(TRY_CAST(v AS BIGINT) IS NOT NULL) "
    "THEN 'BIGINT' ELSE 'TEXT' END WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) THEN 'DOUBLE PRECISION' "
    "WHEN bool_and(lower(v) IN ('true','false','t','f','yes','no','y','n','1','0')) THEN 'BOOLEAN' "
    "WHEN bool_and(try_strptime(v, ['%Y-%m-%d', '%d/%m/%Y', '%m/%d/%Y', '%Y/%m/%d']) IS NOT NULL) THEN 'DATE' "
    "WHEN bool_and(try_strptime(v, ['%H:%M', '%H:%M:%S']) IS NOT NULL) THEN 'TIME' "
    "WHEN bool_and(coalesce(try_strptime(v, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M']), "
    "TRY_CAST(replace(v, 'Z', '') AS TIMESTAMP)) IS NOT NULL) THEN 'TIMESTAMP' ELSE 'TEXT' END"
)


@query(
    "column_types",
    " UNION ALL ".join(
        f"SELECT {i} AS posicion, '{name}' AS columna, {_LADDER} AS tipo FROM "
        f"(SELECT nullif(trim({e}), '') AS v FROM lineitem) WHERE v IS NOT NULL"
        for i, (name, e) in enumerate(zip(_TYPE_NAMES, _TYPED_SOURCE.values()))
    ),
)
def column_types(spark: SparkSession, folder: str) -> DataFrame:
    return tb.column_types(_typed_source(spark, folder))


@query(
    "typed_load",
    "SELECT l_orderkey::INTEGER AS l_orderkey, l_orderkey + 3000000000 AS big_key, l_linenumber <= 1 OR l_linenumber = 2 AS col_2nd_flag, "
    "CASE WHEN l_linenumber = 1 THEN 1.0 ELSE l_discount END AS l_discount, l_returnflag, "
    "CASE WHEN l_linenumber <= 2 THEN '2024-01-31' END AS dia, CASE WHEN l_linenumber = 1 THEN '08:30' ELSE '23:59:59' END AS dia_2, "
    "'2024-01-31 08:30' AS sello FROM lineitem",
)
def typed_load(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "typed")
    writers.load_table(_typed_source(spark, folder), path, "fail")
    loaded = spark.read.parquet(path)
    return loaded.drop("over", "col").withColumns(
        {
            "dia": F.date_format("dia", "yyyy-MM-dd"),
            "sello": F.date_format("sello", "yyyy-MM-dd HH:mm"),
        }
    )


@query(
    "typed_append",
    "SELECT l_orderkey::VARCHAR AS clave, l_linenumber::VARCHAR AS linea, NULL AS motivo FROM lineitem UNION ALL "
    "SELECT (-l_orderkey)::VARCHAR, CASE WHEN l_linenumber > 2 THEN l_linenumber::VARCHAR END, NULL FROM lineitem WHERE l_linenumber <> 1 UNION ALL "
    "SELECT (-l_orderkey)::VARCHAR, 'x' || l_linenumber, 'linea' FROM lineitem WHERE l_linenumber = 1",
)
def typed_append(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended to a table of numbers: one line number in several is no number, or blank."""
    path = shared_path(spark, "appended")
    lines = spread(table(spark, folder, "lineitem"))
    writers.load_table(lines.selectExpr("CAST(l_orderkey AS STRING) AS Clave", "CAST(l_linenumber AS STRING) AS Linea"), path)
    late = "CASE WHEN l_linenumber = 1 THEN 'x1' WHEN l_linenumber = 2 THEN ' ' ELSE CAST(l_linenumber AS STRING) END AS LINEA"
    writers.load_table(lines.selectExpr(late, "CAST(-l_orderkey AS STRING) AS clave"), path)
    stored = spark.read.parquet(path).selectExpr("CAST(clave AS STRING) AS clave", "CAST(linea AS STRING) AS linea", "CAST(NULL AS STRING) AS motivo")
    refused = spark.read.schema("motivo string, _texto string").parquet(f"{path}_rechazos")
    text = lambda name: F.get_json_object("_texto", f"$.{name}").alias(name)
    return stored.unionByName(refused.select(text("clave"), text("linea"), "motivo"))


def _upsert_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Target: every order, and a mirror under negative numbers that no source row touches.
    Source: every order, a quarter of them under new numbers, some sent twice."""
    orders = table(spark, folder, "orders")
    rest = ["o_custkey AS numero_siniestro", "o_orderdate AS fecha_observacion", "o_orderstatus AS usuario"]
    number = F.explode(F.array("o_orderkey", -F.col("o_orderkey") - 1))
    target = orders.withColumn("numero_aviso", number).selectExpr(
        "numero_aviso", *rest, "o_orderpriority AS observacion", "o_totalprice AS precio"
    )
    copies = F.explode(F.sequence(F.lit(0), F.expr("CASE WHEN o_orderkey % 8 IN (4, 5) THEN 1 ELSE 0 END")))
    source = orders.withColumn("copia", copies).selectExpr(
        "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS numero_aviso",
        *rest,
        "'nuevo ' || CAST(copia AS STRING) AS observacion",
        "o_totalprice + copia AS precio",
        "copia",
    )
    return target, source


_UPSERT_CTE = (
    "c AS (SELECT *, CASE WHEN o_orderkey % 8 IN (4, 5) THEN 1 ELSE 0 END AS otra FROM orders), "
    "m AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS numero_aviso, o_custkey AS numero_siniestro, "
    "strftime(o_orderdate, '%Y-%m-%d') AS fecha_observacion, o_orderstatus AS usuario, 'nuevo ' || CAST(otra AS VARCHAR) AS observacion, "
    "o_totalprice + otra AS precio, CASE WHEN o_orderkey % 4 = 0 THEN 'insertada' ELSE 'actualizada' END AS accion, CAST(otra + 1 AS BIGINT) AS copias FROM c "
    "UNION ALL SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus, o_orderpriority, o_totalprice, 'igual', 0 FROM c WHERE o_orderkey % 4 = 0 "
    "UNION ALL SELECT -o_orderkey - 1, o_custkey, strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus, o_orderpriority, o_totalprice, 'igual', 0 FROM c)"
)


@query("keyed_upsert", f"WITH {_UPSERT_CTE} SELECT * FROM m")
def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _upsert_sides(spark, folder)
    merged = tb.upsert(target, source, "copia")
    return merged.withColumns(
        {"fecha_observacion": F.date_format("fecha_observacion", "yyyy-MM-dd"), "copias": F.col("copias").cast("long")}
    )


@query(
    "upsert_counts",
    f"WITH {_UPSERT_CTE} SELECT accion, count(*) AS filas, count(*) FILTER (copias > 1) AS con_duplicados FROM m GROUP BY accion",
)
def upsert_counts(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _upsert_sides(spark, folder)
    return tb.upsert_counts(tb.upsert(target, source, "copia"))


@query(
    "record_upsert",
    f"WITH r AS ({RECORDS_SQL}), t AS (SELECT *, TRY_CAST({sb.strip('numero_aviso')} AS BIGINT) AS na, TRY_CAST({sb.strip('numero_siniestro')} AS BIGINT) AS ns, "
    f"try_strptime({sb.squeeze_strip('fecha_observacion')}, '%Y/%m/%d %I:%M:%S %p') AS f, coalesce(usuario, '') AS u FROM r), "
    "ok AS (SELECT * FROM t WHERE na IS NOT NULL AND ns IS NOT NULL AND f IS NOT NULL AND (confianza IS NULL OR TRY_CAST(confianza AS DOUBLE) IS NOT NULL)), "
    "d AS (SELECT *, row_number() OVER (PARTITION BY na, ns, f, u ORDER BY ord DESC) AS rn, count(*) OVER (PARTITION BY na, ns, f, u) AS copias FROM ok) "
    f"SELECT na AS numero_aviso, ns AS numero_siniestro, u AS usuario, {sb.strip('observacion')} AS observacion, copias FROM d WHERE rn = 1",
)
def record_upsert(spark: SparkSession, folder: str) -> DataFrame:
    good = nt.accepted(nt.typed_records(records(spark, folder)))
    empty = spark.createDataFrame([], good.drop("ord").schema)
    merged = tb.upsert(empty, good, "ord")
    return merged.select(*[c for c in UPSERT_KEY if c != "fecha_observacion"], "observacion", F.col("copias").cast("long").alias("copias"))


_LOAD_CTE = (
    f"n AS ({NOTES_SQL}), c AS (SELECT *, {sb.strip('fecha_observacion')} AS fo FROM n), "
    f"p AS (SELECT *, try_strptime({sb.squeeze('fo')}, '%Y/%m/%d %I:%M:%S %p') AS f FROM c)"
)


def _load_input(spark: SparkSession, folder: str) -> DataFrame:
    scalar = nt.note_scalars(notes(spark, folder), ["fecha_observacion"])
    missing = F.when(F.col("k") % 3 == 0, F.array(F.lit("fecha"), F.lit('ori"gen'))).when(
        F.col("k") % 3 == 1, F.array().cast("array<string>")
    )
    return nt.load_rows(scalar.withColumn("elementos_faltantes", missing))


@query(
    "classified_load",
    f"WITH {_LOAD_CTE} SELECT ord, strftime(f, '%Y-%m-%d %H:%M:%S') AS fecha_observacion, CASE WHEN k % 3 = 0 THEN '[\"fecha\",\"ori\\\"gen\"]' ELSE '[]' END "
    "AS elementos_faltantes FROM p WHERE fo IS NULL OR f IS NOT NULL",
)
def classified_load(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "classified")
    writers.write_accepted(_load_input(spark, folder), f"{path}/table", f"{path}/rejected", "errorifexists")
    return spark.read.parquet(f"{path}/table").select(
        "ord", F.date_format("fecha_observacion", "yyyy-MM-dd HH:mm:ss").alias("fecha_observacion"), "elementos_faltantes"
    )


@query(
    "classified_rejects",
    f"WITH {_LOAD_CTE} SELECT ord, 'fecha_observacion' AS motivo FROM p WHERE fo IS NOT NULL AND f IS NULL",
)
def classified_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return nt.rejected(_load_input(spark, folder)).select("ord", "motivo")


@query(
    "note_csv_export",
    f"SELECT CAST(ord AS VARCHAR) AS ord, nullif({sb.squeeze_strip('observacion')}, '') AS observacion, trim(nit_taller) AS nit_taller, "
    "CASE WHEN k % 3 = 0 THEN 'fecha | ori gen' END AS elementos_faltantes, CASE WHEN k % 2 = 0 THEN '{\"k\":' || CAST(k AS VARCHAR) || '}' END AS extra, "
    f"CASE WHEN k % 5 > 0 THEN '0.' || CAST(k % 5 AS VARCHAR) ELSE '0.0' END AS confianza FROM ({NOTES_SQL})",
)
def note_csv_export(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "notes-export")
    rows = notes(spark, folder).select(
        "ord",
        "observacion",
        "nit_taller",
        F.when(F.col("k") % 3 == 0, F.array(F.lit(" fecha"), F.lit(None), F.lit(" "), F.lit("ori\tgen"))).alias("elementos_faltantes"),
        F.when(F.col("k") % 2 == 0, F.struct("k")).alias("extra"),
        F.expr("CAST(k % 5 AS DOUBLE) / 10").alias("confianza"),
    )
    writers.write_notes_csv(rows, path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query(
    "audit_csv_export",
    "SELECT CAST(o_orderkey AS VARCHAR) AS caso, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus || CASE WHEN o_orderkey % 4 > 1 "
    "THEN ' | ' || o_orderpriority ELSE '' END END AS evidencias, CASE WHEN o_orderkey % 3 > 0 THEN 'Recomendación: uno, \"dos\"' END AS observaciones FROM orders",
)
def audit_csv_export(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "audit-export")
    key = F.col("o_orderkey")
    evidence = (
        F.when(key % 4 == 0, F.array().cast("array<string>"))
        .when(key % 4 == 1, F.array("o_orderstatus", F.lit(None)))
        .otherwise(F.array("o_orderstatus", "o_orderpriority"))
    )
    remarks = F.when(key % 3 > 0, F.array(F.lit('Recomendación: uno, "dos"')))
    audits = table(spark, folder, "orders").select(
        key.alias("caso"), evidence.alias("evidencias"), remarks.alias("observaciones")
    )
    writers.write_audit_csv(audits, path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query("json_line_sink", f"SELECT ord, observacion, k FROM ({NOTES_SQL})")
def json_line_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "json-lines")
    writers.write_json_lines(notes(spark, folder).select("ord", "observacion", "k"), path)
    return readers.read_json_lines(spark, path, _ENVELOPE)


@query(
    "shard_ids",
    "SELECT o_orderkey, r - 1 AS ordinal, CAST(floor((r - 1) / ceil(n / 10.0)) AS BIGINT) AS shard_id FROM "
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders)",
)
def shard_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tb.shards(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 10)


def _chunk_sql(size: str) -> str:
    counts = ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') AS {s}" for s in "FOP")
    return (
        f"SELECT CAST(floor((r - 1) / {size}) AS BIGINT) AS chunk, min(r) - 1 AS desde, max(r) AS hasta, count(*) AS filas, {counts} FROM "
        "(SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders) GROUP BY 1"
    )


@query("chunk_summary_by_size", _chunk_sql("CAST(least(greatest(1, 468), n) AS DOUBLE)"))
def chunk_summary_by_size(spark: SparkSession, folder: str) -> DataFrame:
    return tb.chunk_summary(table(spark, folder, "orders"), ["o_orderkey"], "o_orderstatus", list("FOP"), chunksize=468)


@query("chunk_summary_by_workers", _chunk_sql("greatest(1, ceil(n / 16.0))"))
def chunk_summary_by_workers(spark: SparkSession, folder: str) -> DataFrame:
    return tb.chunk_summary(table(spark, folder, "orders"), ["o_orderkey"], "o_orderstatus", list("FOP"), workers=16)


@query(
    "class_distribution",
    f"SELECT coalesce(clasificacion, 'sin_clasificar') AS clasificacion, count(*) AS registros FROM ({NOTES_SQL}) GROUP BY 1",
)
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return tb.class_distribution(notes(spark, folder))


@query("first_rows", f"SELECT ord, observacion FROM ({NOTES_SQL}) ORDER BY ord LIMIT 20")
def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return tb.head_rows(notes(spark, folder), ["ord"], 20).select("ord", "observacion")


@query(
    "key_union",
    "SELECT CAST(NULL AS VARCHAR) AS placa, c_name AS nombre_taller, CAST(c_custkey AS BIGINT) AS zona, CAST(NULL AS BIGINT) AS alfa FROM customer "
    "UNION ALL SELECT 'P' || CAST(s_suppkey AS VARCHAR), s_name, NULL, s_suppkey FROM supplier",
)
def key_union(spark: SparkSession, folder: str) -> DataFrame:
    left = table(spark, folder, "customer").selectExpr("c_custkey AS zona", "c_name AS nombre_taller")
    right = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS alfa", "s_name AS nombre_taller", "'P' || CAST(s_suppkey AS STRING) AS placa"
    )
    return tb.union_all_keys([left, right])


@query(
    "chunk_ingest",
    "SELECT 'req' || CAST(o_custkey % 5 AS VARCHAR) AS request_id, CAST((o_orderkey - o_orderkey % 100) / 100 AS BIGINT) * 5 + o_custkey % 5 AS chunk_index, "
    "count(*) AS registros, CAST(sum(o_orderkey) AS BIGINT) AS suma, max(pos) AS ultima FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey % 5, "
    "CAST((o_orderkey - o_orderkey % 100) / 100 AS BIGINT) ORDER BY o_orderkey) - 1 AS INTEGER) AS pos FROM orders) GROUP BY 1, 2",
)
def chunk_ingest(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_path(spark, "ingest")
    record = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    part = F.expr("CAST((o_orderkey - o_orderkey % 100) / 100 AS BIGINT) * 5 + o_custkey % 5")
    payloads = (
        table(spark, folder, "orders")
        .groupBy(F.expr("'req' || CAST(o_custkey % 5 AS STRING)").alias("request_id"), part.alias("chunk_index"))
        .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("registros"))
    )
    payloads.write.json(f"{root}/inbox")
    first = ingest.ingest_chunks(spark, f"{root}/inbox", f"{root}/table", f"{root}/state", record)
    payloads.write.mode("append").json(f"{root}/inbox")
    stored = ingest.ingest_chunks(spark, f"{root}/inbox", f"{root}/table", f"{root}/state", record)
    assert first.columns == stored.columns
    return stored.groupBy("request_id", "chunk_index").agg(
        F.count(F.lit(1)).alias("registros"), F.sum("o_orderkey").alias("suma"), F.max("pos").alias("ultima")
    )


