"""Cleaning, event text, case timelines and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.functions import dates as dt
from caselog.functions import text as tx
from caselog.operators import audit as au
from caselog.operators import notes as nt
from caselog.operators import requests as rq
from caselog.operators import timeline as tl
from caselog.plans import sqlbits as sb
from caselog.plans.inputs import NOTES_SQL, notes
from caselog.plans.registry import query, spread, table
from caselog.schemas import NOTE_HEADER


@query(
    "unified_cases",
    f"WITH {sb.CASES_CTE} SELECT * FROM cases",
)
def unified_cases(spark: SparkSession, folder: str) -> DataFrame:
    return tl.unify_cases(notes(spark, folder), "ord")


@query(
    "canonical_columns",
    f"SELECT ord, nit_taller, nombre_taller, numero_aviso, numero_siniestro, placa, usuario, rol_analista, "
    f"observacion, '' AS clasificacion, fecha_observacion FROM ({NOTES_SQL})",
)
def canonical_columns(spark: SparkSession, folder: str) -> DataFrame:
    back = {name: header for header, name in NOTE_HEADER.items() if name != "placa"}
    raw = notes(spark, folder).drop("clasificacion").withColumnsRenamed(back)
    return nt.canonical_columns(raw, keep=["ord"])


# The note header as other exports spell it.
_LOOSE_HEADER = {
    "nit_taller": "Nit  Taller",
    "nombre_taller": "Nombre_Taller",
    "numero_aviso": "Número Aviso",
    "numero_siniestro": "NÚMERO siniestro",
    "placa": "Placa",
    "usuario": "usuario ",
    "rol_analista": "Rol del taller, Rol Analista",
    "observacion": "Observación",
    "fecha_observacion": "Fecha Observación",
}


@query(
    "canonical_columns_loose",
    f"SELECT ord, nit_taller, nombre_taller, numero_aviso, numero_siniestro, placa, usuario, rol_analista, "
    f"observacion, '' AS clasificacion, fecha_observacion FROM ({NOTES_SQL})",
)
def canonical_columns_loose(spark: SparkSession, folder: str) -> DataFrame:
    raw = notes(spark, folder).drop("clasificacion").withColumnsRenamed(_LOOSE_HEADER)
    return nt.canonical_columns(raw, keep=["ord"], partial=True)


@query(
    "cleaned_cells",
    "SELECT ord, " + ", ".join(f"{sb.clean(c)} AS {c}" for c in [*sb.CLEANED, "fecha_observacion"])
    + f" FROM ({NOTES_SQL})",
)
def cleaned_cells(spark: SparkSession, folder: str) -> DataFrame:
    return nt.clean_cells(notes(spark, folder)).select("ord", *nt.CLEANED)


@query(
    "timeline_dates",
    f"WITH {sb.EVENTS_CTE} SELECT ord, fecha_obs_norm, strftime(fecha_dt, '%Y-%m-%d %H:%M:%S') AS fecha_dt, fecha_fmt FROM ev",
)
def timeline_dates(spark: SparkSession, folder: str) -> DataFrame:
    events = nt.event_columns(nt.clean_cells(notes(spark, folder)))
    stamp = F.date_format("fecha_dt", "yyyy-MM-dd HH:mm:ss").alias("fecha_dt")
    return events.select("ord", "fecha_obs_norm", stamp, "fecha_fmt")


_ORDER_DATE = (
    "CASE o_orderkey % 11 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') "
    "WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 3 THEN strftime(o_orderdate, '%d-%m-%Y') "
    "WHEN 4 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 5 THEN strftime(o_orderdate, '%m-%d-%Y') "
    "WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 7 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') "
    "WHEN 8 THEN ' ' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || ' ' WHEN 9 THEN strftime(o_orderdate, '%Y/%m/%d %I:%M:%S %p') "
    "ELSE 'sin fecha' END"
)


@query(
    "mixed_audit_dates",
    f"SELECT o_orderkey, texto, strftime(coalesce(try_strptime(trim(texto), ['%Y-%m-%d', '%Y/%m/%d', '%d/%m/%Y', "
    "'%d-%m-%Y', '%m/%d/%Y', '%m-%d-%Y', '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S']), try_strptime(trim(texto), "
    "'%Y-%m-%dT%H:%M:%S')), '%Y-%m-%d') AS fecha, strftime(coalesce(try_strptime(trim(texto), ['%Y-%m-%d', '%Y/%m/%d', "
    "'%d/%m/%Y', '%d-%m-%Y', '%m/%d/%Y', '%m-%d-%Y', '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S', '%Y/%m/%d %I:%M:%S %p']), "
    "try_strptime(trim(texto), '%Y-%m-%dT%H:%M:%S')), '%Y-%m-%d') AS fecha_con_reloj "
    f"FROM (SELECT o_orderkey, {_ORDER_DATE} AS texto FROM orders)",
)
def mixed_audit_dates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    shapes = [
        "yyyy-MM-dd",
        "yyyy/MM/dd",
        "dd/MM/yyyy",
        "dd-MM-yyyy",
        "MM/dd/yyyy",
        "MM-dd-yyyy",
        "yyyy-MM-dd HH:mm:ss",
        "dd/MM/yyyy HH:mm:ss",
        "' 'yyyy-MM-dd'T'HH:mm:ss' '",
        "yyyy/MM/dd hh:mm:ss a",
    ]
    text = F.lit("sin fecha")
    for i, shape in enumerate(shapes):
        text = F.when(F.col("o_orderkey") % 11 == i, F.date_format(day, shape)).otherwise(text)
    rendered = table(spark, folder, "orders").select("o_orderkey", text.alias("texto"))
    return rendered.select(
        "o_orderkey",
        "texto",
        dt.audit_date(F.col("texto")).alias("fecha"),
        dt.audit_date(F.col("texto"), with_clock_format=True).alias("fecha_con_reloj"),
    )


@query("event_text", f"WITH {sb.EVENTS_CTE} SELECT ord, evento FROM ev")
def event_text(spark: SparkSession, folder: str) -> DataFrame:
    return nt.event_columns(nt.clean_cells(notes(spark, folder))).select("ord", "evento")


_LISTED = (
    "CASE o_orderkey % 6 WHEN 0 THEN ' [' || CAST(o_custkey AS STRING) || ', 2] ' WHEN 1 THEN '[\"' || o_orderpriority || '\"]' "
    "WHEN 2 THEN '[]' WHEN 3 THEN '[' || o_orderpriority || ']' WHEN 4 THEN '  ' ELSE ' ' || o_orderstatus || ' ' END"
)


@query(
    "list_scalars",
    "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_orderpriority "
    "WHEN 2 THEN '[]' WHEN 3 THEN '[' || o_orderpriority || ']' WHEN 4 THEN NULL ELSE o_orderstatus END AS valor, "
    "CASE o_orderkey % 6 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_orderpriority WHEN 2 THEN '[]' "
    "WHEN 3 THEN '[' || o_orderpriority || ']' WHEN 4 THEN '' ELSE o_orderstatus END AS valor_caso FROM orders",
)
def list_scalars(spark: SparkSession, folder: str) -> DataFrame:
    cells = table(spark, folder, "orders").selectExpr("o_orderkey", f"{_LISTED} AS valor", f"{_LISTED} AS valor_caso")
    return nt.note_scalars(nt.note_scalars(cells, ["valor"]), ["valor_caso"], blank_to_null=False)


@query(
    "pipe_safe_documents",
    "SELECT doc_id, md5(t) AS huella, length(t) AS largo, NOT contains(t, '|') AS sin_barras FROM (SELECT doc_id, "
    + sb.squeeze_strip("replace(coalesce(text, ''), '|', ' / ')")
    + " AS t FROM documents)",
)
def pipe_safe_documents(spark: SparkSession, folder: str) -> DataFrame:
    safe = spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", tx.pipe_safe(F.col("text")).alias("t"))
    return safe.select(
        "doc_id",
        F.md5("t").alias("huella"),
        F.length("t").cast("long").alias("largo"),
        (~F.contains("t", F.lit("|"))).alias("sin_barras"),
    )


_RECORD_AVISO = "CASE WHEN ord % 37 = 0 THEN 'A-' || CAST(ord AS STRING) ELSE ' ' || CAST(ord % 500 AS STRING) || ' ' END"
_RECORD_CONF = "CASE WHEN ord % 41 = 0 THEN 'alta' WHEN ord % 5 = 0 THEN NULL ELSE '0.' || CAST(ord % 10 AS STRING) END"
_RECORD_COLUMNS = [
    "ord",
    "nit_taller",
    "nombre_taller",
    f"{_RECORD_AVISO} AS numero_aviso",
    "numero_siniestro",
    "placa",
    "fecha_observacion",
    "usuario",
    "rol_analista",
    "observacion",
    "clasificacion",
    "CAST(NULL AS STRING) AS explicacion",
    f"{_RECORD_CONF} AS confianza",
]
RECORDS_SQL = f"SELECT {', '.join(_RECORD_COLUMNS)} FROM ({NOTES_SQL})"


def records(spark: SparkSession, folder: str) -> DataFrame:
    return notes(spark, folder).selectExpr(*_RECORD_COLUMNS)


@query(
    "typed_records",
    f"WITH r AS ({RECORDS_SQL}), t AS (SELECT *, TRY_CAST({sb.strip('numero_aviso')} AS BIGINT) AS na, "
    f"TRY_CAST({sb.strip('numero_siniestro')} AS BIGINT) AS ns, try_strptime({sb.squeeze_strip('fecha_observacion')}, "
    "'%Y/%m/%d %I:%M:%S %p') AS f FROM r) SELECT ord, trim(nit_taller) AS nit_taller, trim(nombre_taller) AS nombre_taller, "
    f"na AS numero_aviso, ns AS numero_siniestro, upper({sb.strip('placa')}) AS placa, strftime(f, '%Y-%m-%d %H:%M:%S') AS fecha_observacion, "
    f"coalesce(usuario, '') AS usuario, rol_analista, {sb.strip('observacion')} AS observacion, clasificacion, explicacion, "
    "CAST(TRY_CAST(TRY_CAST(confianza AS DOUBLE) AS DECIMAL(5,3)) AS VARCHAR) AS confianza, "
    "CASE WHEN na IS NULL THEN 'numero_aviso' WHEN ns IS NULL THEN 'numero_siniestro' WHEN f IS NULL THEN 'fecha_observacion' "
    "WHEN confianza IS NOT NULL AND TRY_CAST(confianza AS DOUBLE) IS NULL THEN 'confianza' END AS motivo FROM t",
)
def typed_records(spark: SparkSession, folder: str) -> DataFrame:
    typed = nt.typed_records(records(spark, folder))
    return typed.withColumns(
        {
            "fecha_observacion": F.date_format("fecha_observacion", "yyyy-MM-dd HH:mm:ss"),
            "confianza": F.col("confianza").cast("string"),
        }
    )


@query(
    "piece_counts",
    f"WITH {sb.CASES_CTE} SELECT numero_siniestro, placa, CAST(len(list_filter(string_split(observaciones_unidas, '|'), "
    "lambda x: trim(x) <> '')) AS INTEGER) AS piezas, total_eventos, eventos_no_vacios FROM cases",
)
def piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    cases = tl.unify_cases(notes(spark, folder), "ord")
    pieces = tl.count_pieces(F.col("observaciones_unidas")).alias("piezas")
    return cases.select("numero_siniestro", "placa", pieces, "total_eventos", "eventos_no_vacios")


_AVISO, _SINI, _PLACA = (f"nullif({sb.strip(c)}, '')" for c in ("numero_aviso", "numero_siniestro", "placa"))
_LINKS_CTE = (
    f"n AS ({NOTES_SQL}), l AS (SELECT ord, fecha_observacion, observacion, {_AVISO} AS a, {_SINI} AS s, {_PLACA} AS p FROM n), "
    "links AS (SELECT *, CASE WHEN a IS NOT NULL THEN 'aviso' WHEN s IS NOT NULL THEN 'siniestro' WHEN p IS NOT NULL THEN 'placa' "
    "ELSE 'fila' END AS tipo, coalesce(a, s, p, CAST(ord AS VARCHAR)) AS clave FROM l)"
)


@query("case_links", f"WITH {_LINKS_CTE} SELECT ord, tipo, clave FROM links")
def case_links(spark: SparkSession, folder: str) -> DataFrame:
    return tl.case_links(notes(spark, folder), "ord").select("ord", "tipo", "clave")


_ZEROED = "CASE WHEN ord % 4 = 0 THEN '0' WHEN ord % 4 = 1 THEN ' 0.0 ' ELSE numero_aviso END"


@query(
    "case_links_without_zero",
    f"WITH n0 AS ({NOTES_SQL}), "
    + _LINKS_CTE.replace(f"n AS ({NOTES_SQL})", f"n AS (SELECT * REPLACE (CASE WHEN ord % 4 < 2 THEN '' ELSE numero_aviso END AS numero_aviso, "
    "CASE WHEN trim(numero_siniestro) = '0' THEN NULL ELSE numero_siniestro END AS numero_siniestro) FROM n0)")
    + " SELECT ord, tipo, clave FROM links",
)
def case_links_without_zero(spark: SparkSession, folder: str) -> DataFrame:
    zeroed = notes(spark, folder).withColumn("numero_aviso", F.expr(_ZEROED))
    return tl.case_links(zeroed, "ord", skip_zero=True).select("ord", "tipo", "clave")


def _linked_sql(date: str) -> str:
    note = sb.squeeze_strip("replace(coalesce(observacion, ''), '|', ' / ')")
    return (
        f"WITH {_LINKS_CTE}, chosen AS (SELECT tipo, clave, count(*) AS notas FROM links GROUP BY tipo, clave), "
        f"pieces AS (SELECT *, coalesce({date}, '0000-00-00') AS fecha, {note} AS nota FROM links), "
        "members AS (SELECT 'aviso' AS tipo, a AS clave, fecha, ord, nota FROM pieces WHERE a IS NOT NULL UNION ALL "
        "SELECT 'siniestro', s, fecha, ord, nota FROM pieces WHERE s IS NOT NULL UNION ALL "
        "SELECT 'placa', p, fecha, ord, nota FROM pieces WHERE p IS NOT NULL UNION ALL "
        "SELECT 'fila', clave, fecha, ord, nota FROM pieces WHERE tipo = 'fila') "
        "SELECT c.tipo, c.clave, c.notas, CAST(count(*) FILTER (nota <> '') AS BIGINT) AS total, CAST(0 AS BIGINT) AS parte, CAST(1 AS BIGINT) AS partes, "
        "coalesce(string_agg(trim(fecha || ' - ' || nota, ' -'), ' | ' ORDER BY fecha, ord) FILTER (nota <> ''), '') AS texto "
        "FROM members m JOIN chosen c ON m.tipo = c.tipo AND m.clave = c.clave GROUP BY c.tipo, c.clave, c.notas"
    )


_AUDIT_DATE_SQL = (
    "strftime(try_strptime(trim(fecha_observacion), ['%Y-%m-%d', '%Y/%m/%d', '%d/%m/%Y', '%d-%m-%Y', '%m/%d/%Y', "
    "'%m-%d-%Y', '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S']), '%Y-%m-%d')"
)


@query("linked_timelines", _linked_sql(_AUDIT_DATE_SQL))
def linked_timelines(spark: SparkSession, folder: str) -> DataFrame:
    return tl.linked_timelines(notes(spark, folder), "ord")


@query("linked_timelines_raw_dates", _linked_sql("nullif(fecha_observacion, '')"))
def linked_timelines_raw_dates(spark: SparkSession, folder: str) -> DataFrame:
    return tl.linked_timelines(notes(spark, folder), "ord", parsed_dates=False)


_JSON_CELLS = ", ".join(
    f"'\"{header}\":' || coalesce(to_json({name})::VARCHAR, 'null')" for header, name in NOTE_HEADER.items()
)


@query(
    "note_requests",
    f"SELECT ord, human, sha256('NOTA' || chr(1) || 'notas' || chr(1) || human) AS request_id, registro FROM (SELECT ord, "
    f"'Observación: ' || coalesce(observacion, 'None') AS human, '{{' || concat_ws(',', {_JSON_CELLS}) || '}}' AS registro FROM ({NOTES_SQL}))",
)
def note_requests(spark: SparkSession, folder: str) -> DataFrame:
    rows = notes(spark, folder)
    human = rq.note_text(F.col("observacion"))
    return rows.select(
        "ord",
        human.alias("human"),
        rq.request_id(F.lit("NOTA"), F.lit("notas"), human).alias("request_id"),
        rq.note_record(rows).alias("registro"),
    )


def entry_sql(fields: list[str]) -> str:
    lines = [
        f"'  \"{f}\": ' || " + (f"CAST({f} AS VARCHAR)" if f == "total_eventos" else f"to_json({f})::VARCHAR") for f in fields
    ]
    return "'{' || chr(10) || concat_ws(',' || chr(10), " + ", ".join(lines) + ") || chr(10) || '}'"


@query(
    "case_requests",
    f"WITH {sb.CASES_CTE} SELECT numero_siniestro, placa, '<ENTRADA>' || chr(10) || {entry_sql(rq.CASE_FIELDS)} "
    "|| chr(10) || '</ENTRADA>' AS human FROM cases WHERE observaciones_unidas <> ''",
)
def case_requests(spark: SparkSession, folder: str) -> DataFrame:
    cases = tl.unify_cases(notes(spark, folder), "ord").where("observaciones_unidas <> ''")
    return cases.select("numero_siniestro", "placa", rq.case_text(cases).alias("human"))


@query(
    "strict_case_requests",
    f"WITH {sb.CASES_CTE} SELECT numero_siniestro, placa, md5('{rq.STRICT_HEAD}<ENTRADA>' || chr(10) || {entry_sql(rq.STRICT_FIELDS)} "
    f"|| chr(10) || '</ENTRADA>' || chr(10) || chr(10) || 'FORMATO_DE_SALIDA:' || chr(10) || '{rq.STRICT_TEMPLATE}') AS huella "
    "FROM cases WHERE observaciones_unidas <> ''",
)
def strict_case_requests(spark: SparkSession, folder: str) -> DataFrame:
    cases = tl.unify_cases(notes(spark, folder), "ord").where("observaciones_unidas <> ''")
    return cases.select("numero_siniestro", "placa", F.md5(rq.strict_case_text(cases)).alias("huella"))


@query(
    "prompt_selection",
    "SELECT q.o_orderkey, q.system_key, CASE WHEN q.o_orderkey % 3 = 3 THEN NULL ELSE r.r_name END AS system, "
    "CASE WHEN r.r_name IS NULL THEN 'prompt no encontrado' END AS aviso FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 5 "
    "THEN 'p' || CAST(o_orderkey % 7 AS VARCHAR) ELSE 'otro' END AS system_key FROM orders) q LEFT JOIN region r "
    "ON q.system_key = 'p' || CAST(r.r_regionkey AS VARCHAR)",
)
def prompt_selection(spark: SparkSession, folder: str) -> DataFrame:
    catalog = table(spark, folder, "region").selectExpr(
        "'v4' AS version", "'p' || CAST(r_regionkey AS STRING) AS key", "r_name AS text"
    )
    asked = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 7 < 5 THEN 'p' || CAST(o_orderkey % 7 AS STRING) ELSE 'otro' END AS system_key",
    )
    found = rq.with_prompts(asked, catalog, "v4")
    return found.withColumn("aviso", F.when(F.col("system").isNull(), F.lit("prompt no encontrado")))


BLANKED_STRETCH = "CASE WHEN caso % 3 = 0 OR event_stretch THEN ' ' ELSE observacion END".replace(
    "event_stretch", "ord % 4000 > 1500"
)
BLANKED = "CASE WHEN caso % 3 = 0 THEN ' ' ELSE observacion END"


@query(
    "empty_case_records",
    f"WITH n0 AS ({NOTES_SQL}), "
    + sb.CASES_CTE.replace(f"notes AS ({NOTES_SQL})", f"notes AS (SELECT * REPLACE ({BLANKED} AS observacion) FROM n0)")
    + " SELECT numero_aviso, numero_siniestro, placa, CAST(0 AS BIGINT) AS total_eventos, 'sin datos' AS resumen_general, "
    "0 AS score_final_0a100, 'Nota/Supuesto: no se encontraron observaciones para evaluar.' AS observaciones, 'baja' AS confianza "
    "FROM cases WHERE observaciones_unidas = ''",
)
def empty_case_records(spark: SparkSession, folder: str) -> DataFrame:
    blank = notes(spark, folder).withColumn("observacion", F.expr(BLANKED))
    records_ = au.empty_case_records(tl.unify_cases(blank, "ord"))
    return records_.select(
        "numero_aviso",
        "numero_siniestro",
        "placa",
        "total_eventos",
        "resumen_general",
        "score_final_0a100",
        F.array_join("observaciones", " | ").alias("observaciones"),
        "confianza",
    )


@query(
    "unified_cases_in_parts",
    f"WITH n0 AS ({NOTES_SQL}), "
    + sb.CASES_CTE.replace(f"notes AS ({NOTES_SQL})", f"notes AS (SELECT * REPLACE ({BLANKED_STRETCH} AS observacion) FROM n0)")
    + ", p AS (SELECT numero_siniestro, placa, total_eventos, eventos_no_vacios, unnest(string_split(observaciones_unidas, '|')) AS pieza, "
    "generate_subscripts(string_split(observaciones_unidas, '|'), 1) - 1 AS pos FROM cases) "
    "SELECT numero_siniestro, placa, total_eventos, eventos_no_vacios, CAST(pos AS BIGINT) AS pos, "
    f"{sb.strip('pieza')} AS texto FROM p WHERE {sb.strip('pieza')} <> ''",
)
def unified_cases_in_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every case cut into parts of a few events, with long stretches of blank notes: its pieces, counted through."""
    blank = notes(spark, folder).withColumn("observacion", F.expr(BLANKED_STRETCH))
    parts = tl.unify_cases(blank, "ord", part_bytes=100)
    case = [*tl.CASE_KEY, "total_eventos", "eventos_no_vacios"]
    return tl.split_pieces(parts, case, "observaciones_unidas").select(*case, "pos", "texto")
