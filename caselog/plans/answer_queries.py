"""Model answers: extraction, parsing, validation, folding, audits, merges and contract checks.

The SQL twins state what each shape of answer must give, from the shape number alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.functions import numbers as nb
from caselog.operators import answers as an
from caselog.operators import audit as au
from caselog.operators import content as ct
from caselog.operators import requests as rq
from caselog.plans.inputs import AUDITS_SQL, NOTES_SQL, RESPONSES_SQL, audit_answers, notes, responses
from caselog.plans.registry import dealt, query, spread, table
from caselog.schemas import ALERTS_ANSWER, QUALITY_ANSWER, SCORE_PARTS
from caselog.session import shared_path

KEY = ["request_id", "attempt"]


@query(
    "basic_candidates",
    "SELECT request_id, attempt, CASE shape WHEN 1 THEN replace(regexp_extract(raw, '\\{.*\\}'), chr(10), '') "
    "WHEN 14 THEN replace(replace(replace(raw, 'º', 'o'), '…', '...'), chr(160), ' ') ELSE raw END AS texto "
    f"FROM ({RESPONSES_SQL})",
)
def basic_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return an.with_basic_candidate(responses(spark, folder), "raw", "texto").select(*KEY, "texto")


_BASIC_TIER = "CASE WHEN shape IN (0, 1, 8, 9, 10, 11, 13, 14, 15) THEN 1 WHEN shape = 2 THEN 2 ELSE 0 END"
_ROBUST_TIER = "CASE WHEN shape IN (0, 8, 9, 10, 11, 13, 14, 15) THEN 1 WHEN shape IN (1, 2, 3, 12) THEN 2 WHEN shape = 4 THEN 3 ELSE 0 END"


def _parsed_sql(tier: str) -> str:
    return (
        f"SELECT request_id, attempt, {tier} AS parse_tier, CASE WHEN {tier} = 0 THEN NULL WHEN shape = 8 THEN 'otra' "
        "WHEN shape = 10 THEN ' ' || cls || ' ' WHEN shape = 15 THEN NULL ELSE cls END AS clasificacion, "
        f"CASE WHEN {tier} > 0 THEN CASE shape WHEN 0 THEN 6 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 8 THEN 2 "
        f"WHEN 9 THEN 3 WHEN 10 THEN 5 WHEN 11 THEN 5 WHEN 12 THEN 2 WHEN 13 THEN 4 WHEN 14 THEN 4 ELSE 0 END END AS claves FROM ({RESPONSES_SQL})"
    )


def _parsed(df: DataFrame) -> DataFrame:
    return df.select(
        *KEY,
        "parse_tier",
        F.try_element_at("answer", F.lit("clasificacion")).alias("clasificacion"),
        F.when(F.col("answer").isNotNull(), F.size("answer")).alias("claves"),
    )


@query("parse_basic", _parsed_sql(_BASIC_TIER))
def parse_basic(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(an.parse_basic(responses(spark, folder)))


@query("parse_robust", _parsed_sql(_ROBUST_TIER))
def parse_robust(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(an.parse_robust(responses(spark, folder)))


_REASON = (
    f"CASE WHEN {_BASIC_TIER} = 0 THEN 'sin_json' WHEN shape = 15 THEN 'objeto_vacio' WHEN shape = 8 THEN 'clasificacion' "
    "WHEN shape = 9 THEN 'confianza' WHEN shape = 11 THEN 'explicacion_calidad' END"
)
# Normalized values of the shapes whose core is valid.
_CORE_OK = "shape IN (0, 1, 2, 10, 11, 13, 14)"
_EXPLAIN = "CASE WHEN shape IN (0, 1, 2, 11) THEN 'texto ' || CAST(rid AS VARCHAR) WHEN shape = 10 THEN 'dos' WHEN shape = 14 THEN 'n.o 5...' ELSE 'sin explicación' END"
_CONF = "CASE shape WHEN 0 THEN 0.9 WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 WHEN 11 THEN 0.75 WHEN 13 THEN 0.25 ELSE 0.0 END::DOUBLE"
_SCORE = "CASE shape WHEN 0 THEN 74 WHEN 1 THEN 90 WHEN 2 THEN 76 WHEN 11 THEN 12 WHEN 14 THEN 100 ELSE 0 END"
_QUALITY = "CASE WHEN shape = 0 THEN 'bien' ELSE 'Sin evaluación de calidad comunicativa.' END"
_MISSING = "CASE shape WHEN 0 THEN 'fecha | None' WHEN 2 THEN 'origen' WHEN 13 THEN '7' ELSE '' END"


@query(
    "validation_gate",
    f"SELECT request_id, attempt, {_REASON} AS reject_reason, {_REASON} IS NULL OR shape = 11 AS core_valid, {_REASON} IS NULL AS valid FROM ({RESPONSES_SQL})",
)
def validation_gate(spark: SparkSession, folder: str) -> DataFrame:
    checked = an.validate(an.parse_basic(responses(spark, folder)))
    return checked.select(*KEY, "reject_reason", "core_valid", "valid")


@query(
    "normalized_answers",
    f"SELECT request_id, attempt, cls AS clasificacion, {_EXPLAIN} AS explicacion, {_CONF} AS confianza, {_SCORE} AS calidad_comunicativa_score, "
    f"{_QUALITY} AS explicacion_calidad, {_MISSING} AS elementos_faltantes FROM ({RESPONSES_SQL}) WHERE {_CORE_OK} AND shape <> 11",
)
def normalized_answers(spark: SparkSession, folder: str) -> DataFrame:
    checked = an.validate(an.parse_basic(responses(spark, folder))).where("valid")
    missing = F.array_join("elementos_faltantes", " | ").alias("elementos_faltantes")
    return checked.select(*KEY, *an.CORE, "explicacion_calidad", missing)


def _fold_sql(parity: bool) -> str:
    core = f"{_CORE_OK}" if parity else f"{_CORE_OK} AND shape <> 11"
    return (
        f"WITH r AS ({RESPONSES_SQL}), v AS (SELECT *, min(CASE WHEN {_REASON} IS NULL THEN attempt END) OVER w AS best, "
        f"max(CASE WHEN {core} THEN attempt END) OVER w AS lastcore, max(attempt) OVER w AS intentos FROM r WINDOW w AS (PARTITION BY request_id)), "
        "p AS (SELECT *, coalesce(best, lastcore) AS pick FROM v) SELECT request_id, "
        "coalesce(max(cls) FILTER (attempt = pick), 'sin_clasificar') AS clasificacion, "
        f"coalesce(max({_EXPLAIN}) FILTER (attempt = pick), 'no se pudo parsear salida LLM') AS explicacion, "
        f"coalesce(max({_CONF}) FILTER (attempt = pick), 0.0::DOUBLE) AS confianza, "
        f"coalesce(max({_SCORE}) FILTER (attempt = pick), 0) AS calidad_comunicativa_score, "
        f"coalesce(max({_QUALITY}) FILTER (attempt = best), 'La salida no fue utilizable.') AS explicacion_calidad, "
        f"coalesce(max({_MISSING}) FILTER (attempt = best), '') AS elementos_faltantes, max(best) AS intento_valido, max(intentos) AS intentos "
        "FROM p GROUP BY request_id"
    )


def _folded(spark: SparkSession, folder: str, parity: bool) -> DataFrame:
    folded = an.fold_attempts(an.validate(an.parse_basic(responses(spark, folder))), parity)
    return folded.withColumn("elementos_faltantes", F.array_join("elementos_faltantes", " | "))


@query("attempt_fold", _fold_sql(True))
def attempt_fold(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(spark, folder, True)


@query("attempt_fold_atomic", _fold_sql(False))
def attempt_fold_atomic(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(spark, folder, False)


@query(
    "error_records",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS numero_aviso, CAST(NULL AS VARCHAR) AS placa, 'sin_clasificar' AS clasificacion, "
    "'ValueError: ' || o_orderstatus || o_orderpriority AS explicacion, 0.0::DOUBLE AS confianza, CAST(NULL AS INTEGER) AS calidad_comunicativa_score, "
    "0 AS faltantes FROM orders",
)
def error_records(spark: SparkSession, folder: str) -> DataFrame:
    failed = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CAST(o_custkey AS STRING) AS numero_aviso", "'ValueError: ' || o_orderstatus || o_orderpriority AS error"
    )
    return an.error_records(failed).select(
        "o_orderkey", "numero_aviso", "placa", "clasificacion", "explicacion", "confianza",
        "calidad_comunicativa_score", F.size("elementos_faltantes").alias("faltantes"),
    )


@query(
    "failed_case_records",
    "SELECT o_orderkey, 'error' AS resumen_general, 'error: ' || o_orderstatus || o_orderpriority AS informatividad_justificacion, "
    "'error' AS claridad_justificacion, 0 AS score_final_0a100, 'Nota/Supuesto: error en worker.' AS observaciones, 'baja' AS confianza "
    "FROM orders",
)
def failed_case_records(spark: SparkSession, folder: str) -> DataFrame:
    failed = table(spark, folder, "orders").selectExpr("o_orderkey", "o_orderstatus || o_orderpriority AS error")
    return au.failed_case_records(failed).select(
        "o_orderkey", "resumen_general", "informatividad_justificacion", "claridad_justificacion", "score_final_0a100",
        F.array_join("observaciones", " | ").alias("observaciones"), "confianza",
    )


_READABLE = "shape <> 5"
_SUB = {
    "a": f"CASE WHEN {_READABLE} THEN a ELSE 0 END",
    **{n: f"CASE WHEN {_READABLE} AND shape <> 7 THEN {n} ELSE 0 END" for n in "bde"},
    "c": f"CASE WHEN {_READABLE} AND shape <> 7 THEN least(100, CAST(round_even(c + 0.5, 0) AS INTEGER)) ELSE 0 END",
}
_MEAN = "CAST(round_even((" + " + ".join(f"({v})" for v in _SUB.values()) + ") / 5.0, 0) AS INTEGER)"
_FINAL = f"CASE WHEN shape = 2 THEN 0 WHEN shape = 3 AND a > 0 THEN a WHEN shape = 4 THEN 100 ELSE {_MEAN} END"


@query(
    "sanitized_audits",
    "SELECT request_id, " + ", ".join(f"{v} AS {p}" for p, v in zip(SCORE_PARTS, (_SUB[n] for n in "abcde"))) + ", "
    f"{_FINAL} AS final, CASE WHEN shape = 0 THEN '2024-01-01: uno | dos' WHEN shape = 2 THEN '1 | 2 | 3 | 4 | 5 | 6 | 7 | 8 | 9 | 10 | 11 | 12' ELSE '' END AS evidencias, "
    "CASE WHEN shape = 1 THEN 'Recomendación: ver' WHEN shape = 6 THEN 'Nota/Supuesto: x' ELSE 'Nota/Supuesto: salida por defecto.' END AS observaciones, "
    "CASE WHEN shape = 0 THEN 'alta' WHEN shape = 7 THEN 'media' ELSE 'baja' END AS confianza, "
    "CASE WHEN shape = 4 THEN 'None' ELSE 'No fue posible evaluar.' END AS resumen_general, "
    f"CASE WHEN shape = 3 THEN 'extra' WHEN shape = 7 THEN 'ok' ELSE '' END AS sobrantes FROM ({AUDITS_SQL})",
)
def sanitized_audits(spark: SparkSession, folder: str) -> DataFrame:
    clean = au.sanitize(an.parse_robust(audit_answers(spark, folder)))
    return clean.select(
        "request_id",
        *[F.col(f"{p}_score_0a100").alias(p) for p in SCORE_PARTS],
        F.col("score_final_0a100").alias("final"),
        F.array_join("evidencias", " | ").alias("evidencias"),
        F.array_join("observaciones", " | ").alias("observaciones"),
        "confianza",
        "resumen_general",
        F.coalesce(F.array_join(F.map_keys("extras"), ","), F.lit("")).alias("sobrantes"),
    )


@query(
    "final_score_fallback",
    f"SELECT shape, count(*) AS respuestas, CAST(sum({_FINAL}) AS BIGINT) AS suma_final, CAST(sum({_MEAN}) AS BIGINT) AS suma_media FROM ({AUDITS_SQL}) GROUP BY shape",
)
def final_score_fallback(spark: SparkSession, folder: str) -> DataFrame:
    clean = au.sanitize(an.parse_robust(audit_answers(spark, folder)))
    mean = au.mean_score([F.col(f"{p}_score_0a100") for p in SCORE_PARTS])
    return clean.groupBy("shape").agg(
        F.count(F.lit(1)).alias("respuestas"),
        F.sum("score_final_0a100").alias("suma_final"),
        F.sum(mean).alias("suma_media"),
    )


# Both steps of a case, from orders: some steps fail in every attempt, some answer late.
_STEP_A = (
    "CASE WHEN o_orderkey % 5 = 0 THEN 'ninguna' WHEN o_orderkey % 5 = 1 AND attempt = 1 THEN '[1]' "
    "ELSE '{\"placa\":\"otra\",\"semaforo\":\"' || o_orderstatus || CAST(attempt AS STRING) || '\",\"comun\":\"A\"}' END"
)
_STEP_B = (
    "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '{\"score\":' || CAST(o_custkey AS STRING) || ',\"comun\":\"B\",\"lista\":[1,2]}' END"
)


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    orders = dealt(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")
    tries = orders.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    both = tries.selectExpr("o_orderkey", "attempt", f"{_STEP_A} AS PROMPT_A", f"{_STEP_B} AS PROMPT_B")
    return both.selectExpr(
        "o_orderkey AS request_id", "attempt", "stack(2, 'PROMPT_A', PROMPT_A, 'PROMPT_B', PROMPT_B) AS (step, raw)"
    )


def _merge_sql(plate: str) -> str:
    return (
        f"SELECT o_orderkey AS request_id, {plate} AS placa, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus || CASE WHEN o_orderkey % 5 = 1 THEN '2' ELSE '1' END END AS semaforo, "
        "CASE WHEN o_orderkey % 7 > 0 THEN 'B' WHEN o_orderkey % 5 > 0 THEN 'A' END AS comun, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey AS VARCHAR) END AS score, "
        "CASE WHEN o_orderkey % 7 > 0 THEN '[1,2]' END AS lista, CASE WHEN o_orderkey % 5 = 0 THEN 'Fallo ejecución LLM o parseo JSON' END AS error_a, "
        "CASE WHEN o_orderkey % 7 = 0 THEN 'Fallo ejecución LLM o parseo JSON' END AS error_b FROM orders"
    )


def _merged(spark: SparkSession, folder: str, protected: list[str]) -> DataFrame:
    answered = au.step_answers(an.parse_basic(_steps(spark, folder)))
    base = F.create_map(F.lit("placa"), F.concat(F.lit("P"), F.col("request_id").cast("string")))
    merged = answered.withColumn("m", au.merge_answers(base, [F.col(s) for s in au.STEPS], protected))
    at = lambda key, name=None: F.try_element_at("m", F.lit(key)).alias(name or key)
    return merged.select(
        "request_id", at("placa"), at("semaforo"), at("comun"), at("score"), at("lista"),
        at("error_PROMPT_A", "error_a"), at("error_PROMPT_B", "error_b"),
    )


@query("dual_step_merge", _merge_sql("CASE WHEN o_orderkey % 5 > 0 THEN 'otra' ELSE 'P' || CAST(o_orderkey AS VARCHAR) END"))
def dual_step_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _merged(spark, folder, [])


@query("dual_step_merge_protected", _merge_sql("'P' || CAST(o_orderkey AS VARCHAR)"))
def dual_step_merge_protected(spark: SparkSession, folder: str) -> DataFrame:
    return _merged(spark, folder, ["placa"])


@query(
    "answer_layers",
    "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'k=' || o_orderstatus WHEN 2 THEN '0=' || o_orderstatus || ',1=2' "
    "WHEN 3 THEN 'llm_raw=' || o_orderpriority ELSE '' END AS capas FROM orders",
)
def answer_layers(spark: SparkSession, folder: str) -> DataFrame:
    text = F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '{\"k\":\"' || o_orderstatus || '\"}' WHEN 2 THEN '[\"' || o_orderstatus || '\",2]' "
        "WHEN 3 THEN o_orderpriority ELSE '[]' END"
    )
    layered = au.with_layer(table(spark, folder, "orders").select("o_orderkey", text.alias("t")), "t", "m")
    pairs = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return layered.select("o_orderkey", F.array_join(pairs, ",").alias("capas"))


@query(
    "alert_fields",
    "SELECT c_custkey, c_custkey % 2 = 0 AS detectada, c_mktsegment AS nivel_alerta, CAST(c_custkey % 40 AS INTEGER) AS total, "
    "CAST(c_nationkey AS DOUBLE) + 0.5 AS porcentaje, '2024-01-02|2024-01-09' AS fechas, 7 AS dias, CASE WHEN c_custkey % 3 > 0 THEN 'ROJO' END AS semaforo, "
    "c_custkey % 2 = 1 AS riesgo_legal, 'abogado' AS palabras FROM customer",
)
def alert_fields(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.expr(
        "'{\"alerta_desistimiento_caso_omiso\":{\"detectada\":' || CAST(c_custkey % 2 = 0 AS STRING) || ',\"otra\":1},"
        "\"alertas_comunicacion_cliente\":{\"nivel_alerta\":\"' || c_mktsegment || '\",\"metricas_deteccion\":{\"total_observaciones\":' || CAST(c_custkey % 40 AS STRING) "
        "|| ',\"porcentaje_comunicacion_cliente\":' || CAST(c_nationkey AS STRING) || '.5,\"fechas_contacto_documentado\":[\"2024-01-02\",\"2024-01-09\"],\"dias_entre_contactos\":[7]}},' "
        "|| CASE WHEN c_custkey % 3 > 0 THEN '\"alerta_opre_tiempos\":{\"estado_semaforo\":\"ROJO\"},' ELSE '' END || "
        "'\"sistema_antiquejas_riesgos\":{\"factores_activados\":{\"riesgo_legal\":' || CAST(c_custkey % 2 = 1 AS STRING) || '},\"palabras_clave_halladas\":[\"abogado\"]}}'"
    )
    typed = table(spark, folder, "customer").select("c_custkey", au.typed_answer(raw, ALERTS_ANSWER).alias("x"))
    flat = typed.select("c_custkey", *au.leaves(ALERTS_ANSWER, "x"))
    met = "alertas_comunicacion_cliente__metricas_deteccion__"
    return flat.select(
        "c_custkey",
        F.col("alerta_desistimiento_caso_omiso__detectada").alias("detectada"),
        F.col("alertas_comunicacion_cliente__nivel_alerta").alias("nivel_alerta"),
        F.col(f"{met}total_observaciones").alias("total"),
        F.col(f"{met}porcentaje_comunicacion_cliente").alias("porcentaje"),
        F.array_join(f"{met}fechas_contacto_documentado", "|").alias("fechas"),
        F.get(f"{met}dias_entre_contactos", F.lit(0)).alias("dias"),
        F.col("alerta_opre_tiempos__estado_semaforo").alias("semaforo"),
        F.col("sistema_antiquejas_riesgos__factores_activados__riesgo_legal").alias("riesgo_legal"),
        F.array_join("sistema_antiquejas_riesgos__palabras_clave_halladas", "|").alias("palabras"),
    )


@query(
    "quality_fields",
    "SELECT c_custkey, CAST(c_custkey % 101 AS INTEGER) AS final, c_mktsegment AS categoria, CAST(c_nationkey AS INTEGER) AS informatividad, "
    "CASE WHEN c_custkey % 4 > 0 THEN 30.25::DOUBLE END AS brecha, c_name AS justificacion, 'r1|r2' AS recomendaciones, '2024-01-05' AS primera FROM customer",
)
def quality_fields(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.expr(
        "'{\"evaluacion_calidad_observaciones\":{\"score_final_0a100\":' || CAST(c_custkey % 101 AS STRING) || ',\"categoria_general\":\"' || c_mktsegment || "
        "'\",\"metricas_detalladas\":{\"informatividad\":{\"score_0a100\":' || CAST(c_nationkey AS STRING) || ',\"justificacion\":\"' || c_name || '\"},\"oportunidad\":{' "
        "|| CASE WHEN c_custkey % 4 > 0 THEN '\"brecha_promedio_dias\":30.25' ELSE '' END || '}}},\"recomendaciones_priorizadas\":[\"r1\",\"r2\"],"
        "\"estadisticas_caso\":{\"metricas_temporales\":{\"fecha_primera_observacion\":\"2024-01-05\"}}}'"
    )
    typed = table(spark, folder, "customer").select("c_custkey", au.typed_answer(raw, QUALITY_ANSWER).alias("x"))
    flat = typed.select("c_custkey", *au.leaves(QUALITY_ANSWER, "x"))
    top = "evaluacion_calidad_observaciones__"
    return flat.select(
        "c_custkey",
        F.col(f"{top}score_final_0a100").alias("final"),
        F.col(f"{top}categoria_general").alias("categoria"),
        F.col(f"{top}metricas_detalladas__informatividad__score_0a100").alias("informatividad"),
        F.col(f"{top}metricas_detalladas__oportunidad__brecha_promedio_dias").alias("brecha"),
        F.col(f"{top}metricas_detalladas__informatividad__justificacion").alias("justificacion"),
        F.array_join("recomendaciones_priorizadas", "|").alias("recomendaciones"),
        F.col("estadisticas_caso__metricas_temporales__fecha_primera_observacion").alias("primera"),
    )


# Answers that break every rule for some rows: scores beyond 100, texts of any length, odd words and lists.
_CONTRACT_NUMBERS = {
    "line": "CAST(l_linenumber AS INT)",
    "q": "CAST(l_quantity AS INT)",
    "a": "CAST(l_partkey % 121 AS INT)",
    "b": "CAST(l_suppkey % 111 AS INT)",
    "c": "CAST((l_orderkey * 7) % 105 AS INT)",
    "d": "CAST((l_linenumber * 17) % 119 AS INT)",
    "e": "CAST(CAST(l_quantity AS INT) * 2 + 10 AS INT)",
}
_CONTRACT_SELECT = ", ".join(f"{e} AS {n}" for n, e in _CONTRACT_NUMBERS.items())
_CONTRACT_WORDS = {part: f"((q + {at} * 17) % 90 + 1)" for at, part in enumerate(SCORE_PARTS)}


def _contract_raw(formula: str) -> str:
    parts = "".join(
        f"""'"{part}_score_0a100":' || CAST({letter} AS STRING) || ',"{part}_justificacion":"' || repeat('va ', {_CONTRACT_WORDS[part]}) || '",' || """
        for part, letter in zip(SCORE_PARTS, "abcde")
    )
    return (
        "'{' || " + parts + "'\"resumen_general\":\"' || repeat('va ', q * 4) || '\",\"score_final_0a100\":' || "
        f"CAST(CASE WHEN line % 2 = 0 THEN {formula} ELSE a END AS STRING) || ',\"confianza\":\"' || "
        "CASE line % 3 WHEN 0 THEN 'baja' WHEN 1 THEN 'Alta' ELSE 'media' END || '\",\"observaciones\":[\"Nota/Supuesto: x\",\"' || "
        "CASE WHEN q % 2 = 0 THEN 'Recomendación: ver' ELSE 'ver' END || '\"],\"evidencias\":[\"' || "
        "CASE WHEN q % 3 = 0 THEN 'sin fecha' ELSE '2024-01-01: uno' END || '\"]}'"
    )


_CONTRACT_FORMULA = "CAST({round}((30*a + 25*b + 20*c + 15*d + 10*e) / 100.0, 0) AS INT)"
_DUCK_FORMULA = _CONTRACT_FORMULA.format(round="round_even")
_CONTRACT_FINAL = f"CASE WHEN line % 2 = 0 THEN {_DUCK_FORMULA} ELSE a END"
_AUDIT_BREACHES = {
    **{f"{p}_0_100": f"{x} > 100" for p, x in zip(SCORE_PARTS, "abcde")},
    **{f"{p}_15_80": f"{n} NOT BETWEEN 15 AND 80" for p, n in _CONTRACT_WORDS.items()},
    "final_0_100": f"{_CONTRACT_FINAL} > 100",
    "final_formula": f"{_CONTRACT_FINAL} <> {_DUCK_FORMULA}",
    "resumen_palabras": "q * 4 NOT BETWEEN 50 AND 150",
    "confianza": "line % 3 = 1",
    "prefijo_nota": "q % 2 <> 0",
    "evidencia_con_fecha": "q % 3 = 0",
}


@query(
    "audit_contract",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS regla, count(*) FILTER ({breach}) AS incumplidos, count(*) AS revisados FROM (SELECT {_CONTRACT_SELECT} FROM lineitem)"
        for rule, breach in _AUDIT_BREACHES.items()
    ),
)
def audit_contract(spark: SparkSession, folder: str) -> DataFrame:
    raw = _contract_raw(_CONTRACT_FORMULA.format(round="bround")) + " AS raw"
    answers = spread(table(spark, folder, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in _CONTRACT_NUMBERS.items()]))
    return au.contract_report(au.audit_as_given(an.parse_robust(answers.selectExpr(raw))), au.audit_rules())


_NOTE_RAW = (
    "'{\"clasificacion\":\"' || CASE WHEN o_orderkey % 3 = 0 THEN 'otra' ELSE 'sin_cambio' END || '\",\"explicacion_clasificacion\":\"' || "
    "repeat('va ', CAST(o_orderkey % 30 + 1 AS INT)) || '\",\"confianza_clasificacion\":' || CASE WHEN o_orderkey % 5 = 0 THEN '1.5' ELSE '0.5' END || "
    "',\"calidad_comunicativa_score\":' || CAST(o_orderkey % 130 AS STRING) || ',\"explicacion_calidad\":\"' || "
    "repeat('va ', CAST(o_orderkey % 70 + 1 AS INT)) || '\"}'"
)
_NOTE_BREACHES = {
    "clase": "o_orderkey % 3 = 0",
    "confianza_0_1": "o_orderkey % 5 = 0",
    "calidad_0_100": "o_orderkey % 130 > 100",
    "explicacion_5_25": "o_orderkey % 30 + 1 NOT BETWEEN 5 AND 25",
    "calidad_texto_20_60": "o_orderkey % 70 + 1 NOT BETWEEN 20 AND 60",
}


@query(
    "note_contract",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS regla, count(*) FILTER ({breach}) AS incumplidos, count(*) AS revisados FROM orders"
        for rule, breach in _NOTE_BREACHES.items()
    ),
)
def note_contract(spark: SparkSession, folder: str) -> DataFrame:
    answers = spread(table(spark, folder, "orders").select("o_orderkey")).selectExpr(f"{_NOTE_RAW} AS raw")
    return au.contract_report(au.note_as_given(an.parse_basic(answers)), au.note_rules())


@query(
    "parse_statistics",
    f"SELECT step, {_BASIC_TIER} AS parse_tier, {_REASON} AS reject_reason, count(*) AS respuestas, max(attempt) AS intento_max FROM ({RESPONSES_SQL}) GROUP BY 1, 2, 3",
)
def parse_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return an.parse_statistics(an.validate(an.parse_basic(responses(spark, folder))))


@query(
    "pending_requests",
    "SELECT CAST(o_orderkey AS VARCHAR) AS request_id, o_orderstatus AS step, CAST(CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 1 END AS INTEGER) AS attempt "
    "FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderstatus = 'O')",
)
def pending_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every open order was asked twice; a third of them got a valid answer the second time."""
    orders = table(spark, folder, "orders")
    asked = orders.selectExpr("CAST(o_orderkey AS STRING) AS request_id", "o_orderstatus AS step")
    stored = orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS request_id", "'O' AS step", "o_orderkey", "explode(array(1, 2)) AS attempt"
    )
    return rq.pending(asked, stored.withColumn("valid", F.expr("attempt = 2 AND o_orderkey % 3 = 0")))


class EchoClient:
    """Stand-in for a model: refuses some texts, garbles others once, answers the rest from their length."""

    def __call__(self, messages: list[tuple[str, str]], attempt: int) -> str:
        size = len(messages[-1][1])
        if size % 5 == 0:
            raise TimeoutError("sin respuesta")
        if size % 7 == 0 and attempt == 1:
            return '{"clasificacion":"otra"}'
        return _note_answer(size)


class SteadyClient:
    """Answers every text the way EchoClient does in the end."""

    def __call__(self, messages: list[tuple[str, str]], attempt: int) -> str:
        return _note_answer(len(messages[-1][1]))


def _note_answer(size: int) -> str:
    return '{"clasificacion":"sin_cambio","confianza":0.5,"calidad_comunicativa_score":%d}' % (size % 101)


def _ask_notes(spark: SparkSession, folder: str, clients: list[rq.Client]) -> DataFrame:
    """The notes folded with their answers after one run per client; every tenth has no prompt."""
    path = shared_path(spark, "responses")
    prompts = spark.createDataFrame([("v4", "notas", "instrucciones")], "version string, key string, text string")
    human = rq.note_text(F.col("observacion"))
    key = F.when(F.col("ord") % 10 > 0, F.lit("notas"))
    asked = notes(spark, folder).select(
        "ord",
        F.lit("NOTA").alias("step"),
        key.alias("system_key"),
        human.alias("human"),
        rq.request_id(F.lit("NOTA"), key, human).alias("request_id"),
    )
    asked = rq.with_prompt_flag(asked, prompts, "v4")
    for client in clients:
        options = {"accept": an.judged, "backoff": lambda attempt: 0.0}
        stored = rq.answer_pending(asked.where("con_prompt"), path, client, prompts, "v4", **options)
    done = an.classified_notes(asked.drop("human", "step", "system_key"), an.fold_attempts(an.judged(stored)))
    return done.select("ord", "clasificacion", "explicacion", "calidad_comunicativa_score", "intento_valido", "intentos")


_ASKED = f"SELECT ord, length('Observación: ' || coalesce(observacion, 'None')) AS n, ord % 10 = 0 AS sin_prompt FROM ({NOTES_SQL})"


@query(
    "inferred_notes",
    "SELECT ord, CASE WHEN sin_prompt OR n % 5 = 0 THEN 'sin_clasificar' ELSE 'sin_cambio' END AS clasificacion, "
    "CASE WHEN sin_prompt THEN 'prompt no encontrado' WHEN n % 5 = 0 THEN 'no se pudo parsear salida LLM' ELSE 'sin explicación' END AS explicacion, "
    "CASE WHEN sin_prompt OR n % 5 = 0 THEN 0 ELSE CAST(n % 101 AS INTEGER) END AS calidad_comunicativa_score, "
    "CASE WHEN sin_prompt OR n % 5 = 0 THEN NULL WHEN n % 7 = 0 THEN 2 ELSE 1 END AS intento_valido, "
    f"CASE WHEN sin_prompt THEN NULL WHEN n % 5 = 0 THEN 3 WHEN n % 7 = 0 THEN 2 ELSE 1 END AS intentos FROM ({_ASKED})",
)
def inferred_notes(spark: SparkSession, folder: str) -> DataFrame:
    """Attempt 2 repairs an invalid attempt 1; what always fails is asked three times."""
    return _ask_notes(spark, folder, [EchoClient()])


@query(
    "resumed_notes",
    "SELECT ord, CASE WHEN sin_prompt THEN 'sin_clasificar' ELSE 'sin_cambio' END AS clasificacion, "
    "CASE WHEN sin_prompt THEN 'prompt no encontrado' ELSE 'sin explicación' END AS explicacion, "
    "CASE WHEN sin_prompt THEN 0 ELSE CAST(n % 101 AS INTEGER) END AS calidad_comunicativa_score, "
    "CASE WHEN sin_prompt THEN NULL WHEN n % 5 = 0 THEN 4 WHEN n % 7 = 0 THEN 2 ELSE 1 END AS intento_valido, "
    f"CASE WHEN sin_prompt THEN NULL WHEN n % 5 = 0 THEN 4 WHEN n % 7 = 0 THEN 2 ELSE 1 END AS intentos FROM ({_ASKED})",
)
def resumed_notes(spark: SparkSession, folder: str) -> DataFrame:
    """A later run asks again what failed in the first, and nothing else."""
    return _ask_notes(spark, folder, [EchoClient(), SteadyClient()])


_NOTE_SCORE = "CAST(round_even((40*a + 35*b + 25*d) / 100.0, 0) AS INTEGER)"
_CASE_SCORE = "CAST(round_even((30*a + 25*b + 20*c + 15*d + 10*e) / 100.0, 0) AS INTEGER)"


@query(
    "weighted_scores",
    f"SELECT request_id, {_CASE_SCORE} AS caso, CASE WHEN {_CASE_SCORE} >= 90 THEN 'Excelente' WHEN {_CASE_SCORE} >= 70 THEN 'Bueno' WHEN {_CASE_SCORE} >= 50 "
    f"THEN 'Regular' ELSE 'Deficiente' END AS categoria, {_NOTE_SCORE} AS nota, CASE WHEN {_NOTE_SCORE} >= 90 THEN '90-100' WHEN {_NOTE_SCORE} >= 70 THEN '70-89' "
    f"WHEN {_NOTE_SCORE} >= 50 THEN '50-69' WHEN {_NOTE_SCORE} >= 30 THEN '30-49' WHEN {_NOTE_SCORE} >= 10 THEN '10-29' ELSE '0-9' END AS banda FROM ({AUDITS_SQL})",
)
def weighted_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = audit_answers(spark, folder)
    case = nb.weighted([(F.col(n), w) for n, w in zip("abcde", au.WEIGHTS.values())])
    note = ct.note_quality(F.col("a"), F.col("b"), F.col("d"))
    return rows.select("request_id", case.alias("caso"), note.alias("nota")).select(
        "request_id", "caso", ct.case_level(F.col("caso")).alias("categoria"), "nota", ct.note_band(F.col("nota")).alias("banda")
    )
