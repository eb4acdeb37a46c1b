"""Note and response tables derived from the given tables.

Each table is one list of SQL expressions, read by Spark for the query and by the SQL twin alike.
Only timestamp rendering differs between the two dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.plans.registry import spread, table

SPARK_TIME = {
    "clock": "date_format(ts, 'yyyy/MM/dd  hh:mm:ss a')",
    "iso": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "day": "date_format(ts, 'yyyy-MM-dd')",
    "dmy": "date_format(ts, 'dd/MM/yyyy')",
}
DUCK_TIME = {
    "clock": "strftime(ts, '%Y/%m/%d  %I:%M:%S %p')",
    "iso": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "day": "strftime(ts, '%Y-%m-%d')",
    "dmy": "strftime(ts, '%d/%m/%Y')",
}

# Note texts in the wording of the domain, one per position of the event number.
PHRASES = [
    "'Se llama al cliente para informar avance, cliente aprueba ' || props",
    "'PENDIENTE REPUESTO'",
    "'  PINTURA'",
    "'Ingresa a latonería. Entrega estimada 15/01/2024 ' || props",
    "'sin novedad'",
    "'Se solicita autorización a la aseguradora ' || CAST(user_id AS STRING)",
    "' ' || chr(160) || chr(9)",
    "'Llega repuesto nacional el 2024-01-20 ' || props",
    "'=DESARME'",
    "'Cliente molesto, habla con abogado | demanda ' || CAST(user_id AS STRING)",
    "'WhatsApp enviado' || chr(9) || ' al ' || chr(160) || 'cliente ' || props",
    "'Cotización enviada. Espera 3 días hábiles'",
    "'reproceso de PINTURA, se reprograma cita ' || CAST(user_id % 5 AS STRING)",
    "'Control de calidad y entrega -'",
    "CASE WHEN user_id % 9 = 0 THEN 'Caso cerrado por desistimiento' ELSE 'Recepción del vehículo' END",
    "'...'",
]


def _note_columns(time: dict[str, str]) -> dict[str, str]:
    text = "CASE event_id % 16 " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(PHRASES)) + " END"
    date = (
        f"CASE WHEN event_id % 7 < 3 THEN {time['clock']} || ' ' WHEN event_id % 7 = 3 THEN {time['iso']} "
        f"WHEN event_id % 7 = 4 THEN {time['day']} WHEN event_id % 7 = 5 THEN {time['dmy']} "
        "WHEN event_id % 14 = 6 THEN 'pendiente  fecha' ELSE NULL END"
    )
    return {
        "ord": "event_id",
        "dia": "CAST(ts AS DATE)",
        "caso": "user_id",
        "nit_taller": "' NIT ' || CAST(event_id % 17 AS STRING)",
        "nombre_taller": "'TALLER ' || CAST(user_id % 12 AS STRING)",
        "numero_aviso": "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '' "
        "ELSE '=' || CAST(10000 + user_id * 3 + event_id % 3 AS STRING) END",
        "numero_siniestro": "CASE WHEN user_id % 50 = 7 THEN NULL ELSE ' ' || CAST(user_id AS STRING) || ' ' END",
        "placa": "CASE WHEN user_id % 50 = 7 THEN '  ' ELSE 'p' || CAST(user_id % 97 AS STRING) END",
        "fecha_observacion": date,
        "usuario": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'USER ' || CAST(event_id % 23 AS STRING) END",
        "rol_analista": "CASE WHEN event_id % 5 = 0 THEN 'JEFE' ELSE 'ANALISTA' END",
        "observacion": text,
        "clasificacion": "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_type = 'signup' THEN 'comunicacion_cliente' "
        "WHEN event_type = 'view' THEN 'sin_cambio' WHEN event_type = 'click' THEN 'cambio_estado' "
        "WHEN event_type = 'purchase' THEN 'gestion_repuestos' ELSE '' END",
        "estado_aviso": "CASE WHEN event_id % 4 = 0 THEN 'CERRADO' ELSE 'ABIERTO' END",
        "k": "event_id % 101",
    }


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


NOTES_SQL = _select(_note_columns(DUCK_TIME), "events")


def notes(spark: SparkSession, folder: str) -> DataFrame:
    columns = _note_columns(SPARK_TIME)
    return spread(table(spark, folder, "events")).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


# Shapes of a note answer, by position: how a model may wrap, break or misfill its JSON.
_CLASS = (
    "CASE rid % 4 WHEN 0 THEN 'comunicacion_cliente' WHEN 1 THEN 'cambio_estado' "
    "WHEN 2 THEN 'sin_cambio' ELSE 'gestion_repuestos' END"
)
_HEAD = "'{\"clasificacion\":\"' || cls || '\",\"explicacion_clasificacion\":\"texto ' || CAST(rid AS STRING) || '\",'"
ANSWER_SHAPES = [
    _HEAD + " || '\"confianza_clasificacion\":0.9,\"calidad_comunicativa_score\":74.5,"
    "\"explicacion_calidad\":\" bien \",\"elementos_faltantes\":[\"fecha\",\" \",null]}'",
    "'```JSON' || chr(10) || " + _HEAD + " || '\"confianza_clasificacion\":1.7,\"calidad_comunicativa_score\":\"90\"}' "
    "|| chr(10) || '```'",
    "'Respuesta: ' || " + _HEAD + " || '\"confianza_clasificacion\":0.5,\"calidad_comunicativa_score\":75.5,"
    "\"elementos_faltantes\":\"origen\"} fin'",
    "'{\"clasificacion\":\"' || cls || '\",\"confianza\":0.5,}'",
    "'{''clasificacion'': ''' || cls || ''', ''confianza'': 0.25, ''ok'': True}'",
    "'[{\"clasificacion\":\"cambio_estado\"}]'",
    "''",
    "CAST(NULL AS STRING)",
    "'{\"clasificacion\":\"otra\",\"confianza\":0.5}'",
    "'{\"clasificacion\":\"' || cls || '\",\"confianza_clasificacion\":null,\"confianza\":0.5}'",
    "'{\"clasificacion\":\" ' || cls || ' \",\"explicacion\":\"dos\",\"calidad_comunicativa_score\":null,"
    "\"explicacion_calidad\":\" \",\"elementos_faltantes\":{\"a\":1}}'",
    _HEAD + " || '\"confianza_clasificacion\":0.75,\"calidad_comunicativa_score\":12,\"explicacion_calidad\":5}'",
    "'{“clasificacion”:“' || cls || '”,“confianza”:0.125}'",
    "'{\"clasificacion\":\"otra\",\"clasificacion\":\"' || cls || '\",\"confianza\":\"0.25\","
    "\"calidad_comunicativa_score\":\"90%\",\"elementos_faltantes\":7}'",
    "'{\"clasificacion\":\"' || cls || '\",\"explicacion_clasificacion\":\"n.º' || chr(160) || '5…\","
    "\"confianza\":-3,\"calidad_comunicativa_score\":150}'",
    "'{}'",
]

RESPONSE_KEYS = {
    "event_id": "event_id",
    "rid": "CAST((event_id - event_id % 3) / 3 AS BIGINT)",
    "attempt": "CAST(event_id % 3 + 1 AS INT)",
}
RESPONSE_SHAPE = "CAST((event_id * 7 + rid * 5) % 16 AS INT)"
_RAW = "CASE shape " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(ANSWER_SHAPES)) + " END"

RESPONSES_SQL = (
    f"SELECT *, 'r' || CAST(rid AS STRING) AS request_id, 'NOTA' AS step, {_RAW} AS raw FROM ("
    f"SELECT *, {RESPONSE_SHAPE} AS shape, {_CLASS} AS cls FROM ({_select(RESPONSE_KEYS, 'events')}))"
)


def responses(spark: SparkSession, folder: str) -> DataFrame:
    keyed = table(spark, folder, "events").selectExpr(*[f"{e} AS {n}" for n, e in RESPONSE_KEYS.items()])
    shaped = spread(keyed).selectExpr("*", f"{RESPONSE_SHAPE} AS shape", f"{_CLASS} AS cls")
    return shaped.selectExpr(
        "'r' || CAST(rid AS STRING) AS request_id", "'NOTA' AS step", "attempt", f"{_RAW} AS raw"
    )


# Flat audit answers from line items: sub-scores are remainders of the item's own numbers.
AUDIT_NUMBERS = {
    "request_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "okey": "l_orderkey",
    "line": "l_linenumber",
    "shape": "CAST((l_orderkey * 3 + l_linenumber) % 8 AS INT)",
    "a": "CAST(l_partkey % 101 AS INT)",
    "b": "CAST(l_suppkey % 101 AS INT)",
    "c": "CAST((l_orderkey * 7) % 101 AS INT)",
    "d": "CAST((l_linenumber * 13) % 101 AS INT)",
    "e": "CAST(CAST(l_quantity AS INT) * 2 AS INT)",
}
_SCORES = (
    "'\"informatividad_score_0a100\":' || CAST(a AS STRING) || ',\"oportunidad_score_0a100\":\"' || CAST(b AS STRING) "
    "|| '\",\"orientacion_score_0a100\":' || CAST(c AS STRING) || '.5,\"claridad_score_0a100\":' || CAST(d AS STRING) "
    "|| ',\"consistencia_score_0a100\":' || CAST(e AS STRING)"
)
AUDIT_SHAPES = [
    "'{' || " + _SCORES + " || ',\"confianza\":\"Alta\",\"evidencias\":[\"2024-01-01: uno\",null,\"dos\"],"
    "\"informatividad_justificacion\":\"" + "va " * 15 + "\"}'",
    "'{' || " + _SCORES + " || ',\"score_final_0a100\":0,\"confianza\":\"xx\",\"observaciones\":\" Recomendación: ver \"}'",
    "'{' || " + _SCORES + " || ',\"score_final_0a100\":\"0\",\"confianza\":null,\"evidencias\":[\"1\",\"2\",\"3\",\"4\","
    "\"5\",\"6\",\"7\",\"8\",\"9\",\"10\",\"11\",\"12\"]}'",
    "'{' || " + _SCORES + " || ',\"score_final_0a100\":' || CAST(a AS STRING) || ',\"extra\":\"si\"}'",
    "'{' || " + _SCORES + " || ',\"score_final_0a100\":150,\"resumen_general\":null,}'",
    "'no es json'",
    "'```json' || chr(10) || '{' || " + _SCORES + " || ',\"observaciones\":[\"Nota/Supuesto: x\"]}' || chr(10) || '```'",
    "'{''informatividad_score_0a100'': ' || CAST(a AS STRING) || ', ''confianza'': ''media'', ''ok'': None}'",
]
_AUDIT_RAW = "CASE shape " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(AUDIT_SHAPES)) + " END"
AUDITS_SQL = f"SELECT *, {_AUDIT_RAW} AS raw FROM ({_select(AUDIT_NUMBERS, 'lineitem')})"


def audit_answers(spark: SparkSession, folder: str) -> DataFrame:
    numbers = table(spark, folder, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in AUDIT_NUMBERS.items()])
    return spread(numbers).withColumn("raw", F.expr(_AUDIT_RAW))
