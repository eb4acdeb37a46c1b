"""Case metrics: gaps, contact, content, phases and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.functions import lexicon as lx
from caselog.operators import contact as co
from caselog.operators import content as ct
from caselog.operators import gaps as gp
from caselog.operators import phases as ph
from caselog.operators import timeline as tl
from caselog.plans import sqlbits as sb
from caselog.plans.inputs import NOTES_SQL, notes
from caselog.plans.registry import query, spread, table

ORDER_CASE = ["o_custkey"]


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    return gp.day_profile(table(spark, folder, "orders"), ORDER_CASE, "o_orderdate")


@query(
    "timeline_pieces",
    f"WITH {sb.CASES_CTE}, p AS (SELECT numero_siniestro, placa, unnest(string_split(observaciones_unidas, '|')) AS pieza, "
    "generate_subscripts(string_split(observaciones_unidas, '|'), 1) - 1 AS pos FROM cases) "
    "SELECT numero_siniestro, placa, CAST(pos AS BIGINT) AS pos, "
    "coalesce(nullif(regexp_extract(trim(pieza), '^\\d{4}-\\d{2}-\\d{2}'), ''), 'desconocida') AS fecha, "
    f"{sb.strip('pieza')} AS texto FROM p WHERE {sb.strip('pieza')} <> ''",
)
def timeline_pieces(spark: SparkSession, folder: str) -> DataFrame:
    cases = tl.unify_cases(notes(spark, folder), "ord")
    pieces = tl.split_pieces(cases, tl.CASE_KEY, "observaciones_unidas")
    return pieces.select(*tl.CASE_KEY, "pos", "fecha", "texto")


# Business days between two dates, counted one by one.
_COUNT_WEEKDAYS = (
    "len(list_filter(range(1, date_diff('day', {a}, {b}) + 1), lambda i: isodow({a} + CAST(i AS INTEGER)) < 6))"
)
_DAYS_CTE = (
    "d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dia, count(*) AS notas FROM orders GROUP BY 1, 2), "
    "g AS (SELECT *, lag(dia) OVER (PARTITION BY o_custkey ORDER BY dia) AS dia_previo FROM d)"
)


@query(
    "day_gaps",
    f"WITH {_DAYS_CTE} SELECT o_custkey, strftime(dia, '%Y-%m-%d') AS dia, notas, strftime(dia_previo, '%Y-%m-%d') AS dia_previo, "
    "CAST(date_diff('day', dia_previo, dia) AS INTEGER) AS dias, CASE WHEN dia_previo IS NOT NULL THEN "
    f"CAST({_COUNT_WEEKDAYS.format(a='dia_previo', b='dia')} AS INTEGER) END AS habiles FROM g",
)
def day_gaps(spark: SparkSession, folder: str) -> DataFrame:
    gaps = gp.day_gaps(_profile(spark, folder), ORDER_CASE)
    return gaps.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("dia", "dia_previo")})


_NOTE_GAPS = (
    "o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dia, "
    "lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previo FROM orders), "
    "g AS (SELECT *, date_diff('day', previo, dia) AS dias, CASE WHEN previo IS NOT NULL THEN "
    f"{_COUNT_WEEKDAYS.format(a='previo', b='dia')} END AS habiles FROM o)"
)


@query(
    "gap_statistics",
    f"WITH {_NOTE_GAPS} SELECT o_custkey, count(*) AS notas, strftime(min(dia), '%Y-%m-%d') AS primera, "
    "strftime(max(dia), '%Y-%m-%d') AS ultima, CAST(date_diff('day', min(dia), max(dia)) AS INTEGER) AS dias_duracion, "
    "round(count(*) / greatest(date_diff('day', min(dia), max(dia)) / 7.0, 1.0), 6)::DOUBLE AS notas_por_semana, "
    "CAST(max(dias) AS INTEGER) AS brecha_maxima, CAST(min(dias) AS INTEGER) AS brecha_minima, round(avg(dias), 6) AS brecha_promedio, "
    "CAST(median(dias) AS DOUBLE) AS brecha_mediana, count(*) FILTER (dias > 5) AS brechas_largas, CAST(max(habiles) AS INTEGER) AS brecha_maxima_habil, "
    "round(avg(habiles), 6) AS brecha_promedio_habil, CAST(coalesce(sum(habiles), 0) AS BIGINT) AS dias_habiles FROM g GROUP BY o_custkey",
)
def gap_statistics(spark: SparkSession, folder: str) -> DataFrame:
    stats = gp.gap_metrics(_profile(spark, folder), ORDER_CASE)
    rounded = {c: F.round(c, 6) for c in ("notas_por_semana", "brecha_promedio", "brecha_promedio_habil")}
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("primera", "ultima")}
    return stats.withColumns(rounded | days)


@query(
    "time_lights",
    f"WITH {_NOTE_GAPS}, c AS (SELECT o_custkey, max(dias) AS maximo, max(habiles) AS habil FROM g GROUP BY o_custkey) SELECT o_custkey, "
    "CASE WHEN maximo > 7 THEN 'ROJO' WHEN maximo >= 4 THEN 'AMARILLO' ELSE 'VERDE' END AS estado_semaforo, "
    "CASE WHEN habil <= 2 THEN '90-100' WHEN habil <= 3 THEN '70-89' WHEN habil <= 5 THEN '50-69' WHEN habil <= 7 THEN '30-49' "
    "WHEN habil <= 10 THEN '10-29' WHEN habil > 10 THEN '0-9' END AS banda_oportunidad FROM c",
)
def time_lights(spark: SparkSession, folder: str) -> DataFrame:
    stats = gp.gap_metrics(_profile(spark, folder), ORDER_CASE)
    return stats.select(
        "o_custkey",
        gp.time_light(F.col("brecha_maxima")).alias("estado_semaforo"),
        gp.rhythm_band(F.col("brecha_maxima_habil")).alias("banda_oportunidad"),
    )


_CONTACT_WORDS = ["whatsapp enviado", "llama al cliente"]
_CONTACT_CTE = (
    f"n AS ({NOTES_SQL}), c AS (SELECT caso, dia, {sb.has_any(sb.fold('observacion'), _CONTACT_WORDS)} AS contacto FROM n), "
    "days AS (SELECT DISTINCT caso, dia FROM c WHERE contacto), "
    "gaps AS (SELECT *, date_diff('day', lag(dia) OVER (PARTITION BY caso ORDER BY dia), dia) AS brecha FROM days), "
    "lists AS (SELECT caso, string_agg(strftime(dia, '%Y-%m-%d'), '|' ORDER BY dia) AS fechas, "
    "coalesce(string_agg(CAST(brecha AS VARCHAR), '|' ORDER BY dia), '') AS brechas, "
    "CAST(max(brecha) AS INTEGER) AS maxima, avg(brecha) AS media FROM gaps GROUP BY caso), "
    "m AS (SELECT c.caso, count(*) AS total, count(*) FILTER (contacto) AS con, any_value(fechas) AS fechas, "
    "CAST(greatest(any_value(maxima), min(dia) FILTER (contacto) - min(dia), max(dia) - max(dia) FILTER (contacto)) AS INTEGER) AS silencio, "
    "any_value(brechas) AS brechas, any_value(maxima) AS maxima, any_value(media) AS media "
    "FROM c LEFT JOIN lists USING (caso) GROUP BY c.caso)"
)


def _contact(spark: SparkSession, folder: str) -> DataFrame:
    phrase = co.is_contact(F.col("observacion"), _CONTACT_WORDS)
    return co.contact_metrics(notes(spark, folder), ["caso"], "dia", phrase)


@query(
    "contact_metrics",
    f"WITH {_CONTACT_CTE} SELECT caso, total AS total_observaciones, con AS observaciones_con_contacto_cliente, "
    "round(con * 100.0 / total, 6)::DOUBLE AS porcentaje_comunicacion_cliente, coalesce(fechas, '') AS fechas_contacto_documentado, "
    "coalesce(brechas, '') AS dias_entre_contactos, maxima AS brecha_maxima_sin_contacto_dias, "
    "round(media, 6) AS frecuencia_promedio_contacto_dias, silencio AS silencio_maximo_dias FROM m",
)
def contact_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _contact(spark, folder).withColumns(
        {
            "porcentaje_comunicacion_cliente": F.round("porcentaje_comunicacion_cliente", 6),
            "frecuencia_promedio_contacto_dias": F.round("frecuencia_promedio_contacto_dias", 6),
            "fechas_contacto_documentado": F.array_join("fechas_contacto_documentado", "|"),
            "dias_entre_contactos": F.array_join(F.col("dias_entre_contactos").cast("array<string>"), "|"),
        }
    )


@query(
    "contact_alerts",
    f"WITH {_CONTACT_CTE}, a AS (SELECT *, con * 100.0 / total AS pct, coalesce(silencio, 0) AS b FROM m) SELECT caso, "
    "CASE WHEN con = 0 OR b > 5 THEN 'ROJO' WHEN b >= 3 THEN 'AMARILLO' ELSE 'VERDE' END AS codigo_visual, "
    "CASE WHEN con = 0 OR b > 15 THEN 'CRITICA' WHEN pct < 20 OR b > 7 THEN 'ALTA' WHEN pct < 50 OR b > 5 THEN 'MODERADA' "
    "ELSE 'SIN_ALERTA' END AS nivel_alerta, con = 0 OR b > 15 OR pct < 20 OR b > 7 AS requiere_accion_inmediata FROM a",
)
def contact_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return co.contact_alerts(_contact(spark, folder)).select(
        "caso", "codigo_visual", "nivel_alerta", "requiere_accion_inmediata"
    )


_DOC_WORDS = ["the ", " que", " und"]


@query(
    "contact_share_documents",
    f"SELECT source, count(*) AS notas, count(*) FILTER ({sb.has_any(sb.fold('text'), _DOC_WORDS)}) AS con_contacto, "
    f"count(*) FILTER ({sb.has_any(sb.fold('text'), lx.CONTACT_PHRASES)}) AS con_frase FROM documents GROUP BY source",
)
def contact_share_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(table(spark, folder, "documents").select("source", "text"))
    return documents.groupBy("source").agg(
        F.count(F.lit(1)).alias("notas"),
        F.count_if(co.is_contact(F.col("text"), _DOC_WORDS)).alias("con_contacto"),
        F.count_if(co.is_contact(F.col("text"))).alias("con_frase"),
    )


@query(
    "abandoned_cases",
    f"WITH n AS ({NOTES_SQL}), c AS (SELECT caso, ord % 3 AS grupo, bool_or({sb.has_any(sb.fold('observacion'), lx.CLOSED_WORDS)}) AS cerrado, "
    f"bool_or({sb.has_any(sb.fold('observacion'), lx.CONTACT_VERBS)}) AS con_contacto FROM n GROUP BY 1, 2) "
    "SELECT *, cerrado AND NOT con_contacto AS detectada, CASE WHEN cerrado AND NOT con_contacto THEN 'CRITICO' ELSE 'BAJO' END AS nivel_riesgo FROM c",
)
def abandoned_cases(spark: SparkSession, folder: str) -> DataFrame:
    rows = notes(spark, folder).withColumn("grupo", F.col("ord") % 3)
    return co.abandonment(rows, ["caso", "grupo"], "observacion")


def _any_of(words: list[str]) -> str:
    return f"bool_or({sb.has_any(sb.fold('observacion'), words)})"


@query(
    "complaint_risk",
    f"WITH n AS ({NOTES_SQL}), c AS (SELECT caso, ord % 4 AS grupo, "
    + ", ".join(f"{_any_of([w])} AS w{i}" for i, w in enumerate(lx.COMPLAINT_WORDS))
    + f", {_any_of(lx.LEGAL_WORDS)} AS riesgo_legal, {_any_of(lx.PARTS_WORDS)} AS problemas_repuestos, "
    f"{_any_of(lx.RESCHEDULE_WORDS)} AS reprogramacion_fechas FROM n GROUP BY 1, 2), h AS (SELECT *, concat_ws('|', "
    + ", ".join(f"CASE WHEN w{i} THEN '{w}' END" for i, w in enumerate(lx.COMPLAINT_WORDS))
    + ") AS palabras_clave_halladas FROM c) SELECT caso, grupo, riesgo_legal, problemas_repuestos, reprogramacion_fechas, "
    "palabras_clave_halladas, CASE WHEN riesgo_legal THEN 'ALTO' WHEN palabras_clave_halladas <> '' OR problemas_repuestos "
    "OR reprogramacion_fechas THEN 'MEDIO' ELSE 'BAJO' END AS nivel_riesgo_queja FROM h",
)
def complaint_risk(spark: SparkSession, folder: str) -> DataFrame:
    rows = notes(spark, folder).withColumn("grupo", F.col("ord") % 4)
    risk = ct.complaint_risk(rows, ["caso", "grupo"], "observacion")
    return risk.withColumn("palabras_clave_halladas", F.array_join("palabras_clave_halladas", "|"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("source", "text"))


@query(
    "word_profile",
    "SELECT source, count(*) AS notas, round(avg(w), 6) AS palabras_promedio, round(stddev_pop(w), 6) AS palabras_desviacion, "
    "CAST(min(w) AS INTEGER) AS palabras_min, CAST(max(w) AS INTEGER) AS palabras_max FROM "
    f"(SELECT source, {sb.words('text')} AS w FROM documents) GROUP BY source",
)
def word_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = ct.word_profile(_documents(spark, folder), ["source"], "text")
    return profile.withColumns({c: F.round(c, 6) for c in ("palabras_promedio", "palabras_desviacion")})


def _repeats_sql(key: str, text: str, source: str) -> str:
    folded = f"strip_accents(lower(coalesce({text}, '')))"
    letters = f"regexp_replace({folded}, '[^\\p{{L}}]+', ' ', 'g')"
    near = f"array_to_string(list_sort(list_distinct(list_filter(string_split({letters}, ' '), lambda w: w <> ''))), ' ')"
    return (
        f"WITH t AS (SELECT {key}, {near} AS near, {sb.squeeze_strip(folded)} AS same FROM {source}), c AS (SELECT {key}, "
        f"count(*) AS notas, count(DISTINCT same) AS textos_distintos, count(DISTINCT near) AS grupos FROM t GROUP BY {key}) "
        f"SELECT {key}, notas, textos_distintos, notas - textos_distintos AS repeticiones_exactas, "
        "textos_distintos - grupos AS repeticiones_similares FROM c"
    )


@query("document_repeats", _repeats_sql("source", "text", "documents"))
def document_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return ct.repeats(_documents(spark, folder), ["source"], "text")


@query("note_repeats", _repeats_sql("caso", "observacion", f"({NOTES_SQL})"))
def note_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return ct.repeats(notes(spark, folder), ["caso"], "observacion")


_DATE_SQL = r"'\b\d{4}-\d{1,2}-\d{1,2}\b|\b\d{1,2}/\d{1,2}(/\d{2,4})?\b'"


@query(
    "date_mentions",
    f"SELECT source, count(*) AS notas, count(*) FILTER (regexp_matches(text, {_DATE_SQL})) AS con_fecha, "
    r"count(*) FILTER (regexp_matches(strip_accents(lower(text)), '\b\d+ (dia|semana|hora)s?\b|estimad|plazo')) AS con_plazo FROM "
    f"(SELECT source, text FROM documents UNION ALL SELECT 'notas' AS source, observacion AS text FROM ({NOTES_SQL})) GROUP BY source",
)
def date_mentions(spark: SparkSession, folder: str) -> DataFrame:
    own = notes(spark, folder).select(F.lit("notas").alias("source"), F.col("observacion").alias("text"))
    return ct.date_mentions(_documents(spark, folder).unionByName(own), ["source"], "text")


_GENERIC = f"({sb.strip('observacion')} = '' OR {sb.has_any(sb.fold('observacion'), lx.GENERIC_WORDS)})"
_SHARE = "informativas * 100.0 / notas"


@query(
    "informative_share",
    f"WITH n AS ({NOTES_SQL}), t AS (SELECT caso, {sb.squeeze_strip(sb.fold('observacion'))} AS same, {_GENERIC} AS generica FROM n), "
    "c AS (SELECT caso, count(*) AS notas, count(DISTINCT same) FILTER (NOT generica) AS informativas FROM t GROUP BY caso) "
    f"SELECT caso, notas, informativas, round({_SHARE}, 6)::DOUBLE AS porcentaje_informativo, CASE WHEN {_SHARE} > 80 THEN '90-100' "
    f"WHEN {_SHARE} >= 60 THEN '70-89' WHEN {_SHARE} >= 40 THEN '50-69' WHEN {_SHARE} >= 20 THEN '30-49' "
    f"WHEN {_SHARE} >= 5 THEN '10-29' ELSE '0-9' END AS banda FROM c",
)
def informative_share(spark: SparkSession, folder: str) -> DataFrame:
    share = ct.informative_share(notes(spark, folder), ["caso"], "observacion")
    return share.withColumn("porcentaje_informativo", F.round("porcentaje_informativo", 6))


def _class_sql(text: str, rules: dict[str, list[str]]) -> str:
    cases = " ".join(f"WHEN {sb.has_any(sb.fold(text), words)} THEN '{name}'" for name, words in rules.items())
    return f"CASE {cases} ELSE 'sin_clasificar' END"


# The class each input phrase has by its meaning, written out by position.
_PHRASE_CLASSES = {
    "comunicacion_cliente": (0, 10, 11, 12),
    "gestion_repuestos": (1, 7),
    "cambio_estado": (2, 3, 8),
    "comunicacion_interna": (5,),
    "sin_cambio": (4,),
    "sin_clasificar": (6, 9, 13, 14, 15),
}


@query(
    "rule_classes",
    "SELECT event_id AS ord, CASE "
    + " ".join(f"WHEN event_id % 16 IN {(*at, -1)} THEN '{name}'" for name, at in _PHRASE_CLASSES.items())
    + " END AS clasificacion FROM events",
)
def rule_classes(spark: SparkSession, folder: str) -> DataFrame:
    return notes(spark, folder).select("ord", ct.classify(F.col("observacion")).alias("clasificacion"))


_TURN_RULES = {"a": ["the "], "b": ["que ", "de "], "c": ["und", "der"]}


@query(
    "rule_classes_conversations",
    f"SELECT conv_id, turn, {_class_sql('text', _TURN_RULES)} AS clasificacion FROM conversations",
)
def rule_classes_conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", ct.classify(F.col("text"), _TURN_RULES).alias("clasificacion"))


@query(
    "parts_score_rule",
    f"WITH n AS (SELECT *, {_class_sql('observacion', lx.CLASS_RULES)} AS clase, CAST(k AS INTEGER) AS score, "
    f"regexp_matches(observacion, {_DATE_SQL}) AS fecha, "
    f"regexp_matches({sb.fold(sb.strip('observacion'))}, '^pendiente( por)? repuestos?\\.?$') AS solo FROM ({NOTES_SQL})) "
    "SELECT ord, clase, score, CASE WHEN clase = 'gestion_repuestos' AND NOT fecha THEN CASE WHEN solo "
    "THEN greatest(least(score, 49), 30) ELSE least(score, 60) END ELSE score END AS ajustado FROM n",
)
def parts_score_rule(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("observacion")
    rows = notes(spark, folder).select(
        "ord", "observacion", ct.classify(text).alias("clase"), F.col("k").cast("int").alias("score")
    )
    adjusted = ct.parts_rule(F.col("clase"), F.col("score"), text)
    return rows.select("ord", "clase", "score", adjusted.alias("ajustado"))


@query(
    "missing_elements",
    f"WITH n AS ({NOTES_SQL}), e AS (SELECT nombre_taller, unnest(CASE WHEN ord % 3 = 0 THEN ['Fecha  llegada', 'origen'] "
    "WHEN ord % 3 = 1 THEN ['plan de contingencia', ' ', usuario] ELSE [] END) AS elemento FROM n), "
    f"c AS (SELECT nombre_taller, {sb.squeeze_strip('lower(elemento)')} AS elemento FROM e) SELECT nombre_taller, elemento, count(*) AS veces, "
    "CASE WHEN contains(elemento, 'fecha') OR contains(elemento, 'origen') THEN 'alta' WHEN contains(elemento, 'contingencia') THEN 'media' "
    "ELSE 'opcional' END AS prioridad FROM c WHERE elemento <> '' GROUP BY nombre_taller, elemento",
)
def missing_elements(spark: SparkSession, folder: str) -> DataFrame:
    third = F.col("ord") % 3
    named = F.when(third == 0, F.array(F.lit("Fecha  llegada"), F.lit("origen"))).when(
        third == 1, F.array(F.lit("plan de contingencia"), F.lit(" "), F.col("usuario"))
    )
    rows = notes(spark, folder).withColumn("elementos_faltantes", named)
    return ct.missing_elements(rows, ["nombre_taller"])


_PHASE = "CASE " + " ".join(
    f"WHEN {sb.has_any(sb.fold('observacion'), words)} THEN {i}" for i, words in enumerate(lx.PHASES.values(), start=1)
) + " END"
_PHASED = f"t AS (SELECT caso, ord, dia, {_PHASE} AS fase FROM ({NOTES_SQL})), p AS (SELECT * FROM t WHERE fase IS NOT NULL)"


def _phased(spark: SparkSession, folder: str) -> DataFrame:
    return notes(spark, folder).select("caso", "ord", "dia", ph.phase_number(F.col("observacion")).alias("fase"))


@query(
    "phase_sequence",
    f"WITH {_PHASED}, l AS (SELECT *, lag(fase) OVER (PARTITION BY caso ORDER BY ord) AS antes FROM p) SELECT caso, "
    "count(*) AS notas_con_fase, count(*) FILTER (antes <> fase) AS cambios_fase, count(*) FILTER (antes > fase) AS retrocesos_fase "
    "FROM l GROUP BY caso",
)
def phase_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return ph.phase_sequence(_phased(spark, folder), ["caso"], ["ord"], "fase")


_BACK_SQL = (
    "WITH l AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dia, lag(CAST(o_orderdate AS DATE)) OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderkey) AS antes FROM orders) "
    "SELECT o_custkey, count(*) AS notas_con_fecha, count(*) FILTER (dia < antes) AS retrocesos FROM l GROUP BY o_custkey"
)


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("dia"))


@query("backward_dates", _BACK_SQL)
def backward_dates(spark: SparkSession, folder: str) -> DataFrame:
    return ph.backward_dates(_arrivals(spark, folder), ["o_custkey"], "o_orderkey", "dia")


@query("backward_dates_hot_cases", _BACK_SQL)
def backward_dates_hot_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Same result through the path for hot cases: a low budget makes most customers hot."""
    return ph.backward_dates(_arrivals(spark, folder), ["o_custkey"], "o_orderkey", "dia", budget=8)


@query(
    "stalled_phases",
    f"WITH {_PHASED}, s AS (SELECT *, CASE WHEN lag(fase) OVER w = fase THEN 0 ELSE 1 END AS cambio FROM p "
    "WINDOW w AS (PARTITION BY caso ORDER BY ord)), "
    "r AS (SELECT *, sum(cambio) OVER (PARTITION BY caso ORDER BY ord) AS tramo FROM s), "
    "x AS (SELECT caso, tramo, date_diff('day', arg_min(dia, ord), arg_max(dia, ord)) AS dias FROM r GROUP BY caso, tramo) "
    "SELECT caso, count(*) AS tramos, CAST(max(dias) AS INTEGER) AS dias_fase_mas_larga, max(dias) > 0 AS estancamiento_fase_detectado "
    "FROM x GROUP BY caso",
)
def stalled_phases(spark: SparkSession, folder: str) -> DataFrame:
    return ph.stalled_phases(_phased(spark, folder), ["caso"], ["ord"], "fase", "dia", limit=0)


@query(
    "confidence_tiers",
    f"WITH {sb.EVENTS_CTE}, c AS (SELECT numero_siniestro, ord % 7 AS grupo, count(*) AS total, "
    "count(*) FILTER (fecha_dt IS NOT NULL AND evento IS NOT NULL) AS procesables FROM ev GROUP BY 1, 2) "
    "SELECT numero_siniestro, grupo, total, procesables, CASE WHEN procesables * 100.0 / total > 80 THEN 'alta' "
    "WHEN procesables * 100.0 / total >= 50 THEN 'media' ELSE 'baja' END AS confianza FROM c",
)
def confidence_tiers(spark: SparkSession, folder: str) -> DataFrame:
    events = tl.note_events(notes(spark, folder), "ord")
    usable = F.col("fecha_dt").isNotNull() & F.col("evento").isNotNull()
    case = events.groupBy("numero_siniestro", (F.col("ord") % 7).alias("grupo")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(usable).alias("procesables")
    )
    return case.withColumn("confianza", gp.confidence_tier(F.col("procesables"), F.col("total")))
