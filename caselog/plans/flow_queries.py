"""Both audits with a stand-in client whose answers follow from the text it is sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.operators import requests as rq
from caselog.operators import timeline as tl
from caselog.plans import flows
from caselog.plans import sqlbits as sb
from caselog.plans.case_queries import BLANKED, entry_sql
from caselog.plans.inputs import NOTES_SQL, notes
from caselog.plans.registry import query
from caselog.session import shared_path

NO_WAIT = {"backoff": lambda attempt: 0.0}


class CaseClient:
    """Answers the alert step always and the quality step for three texts in four."""

    def __call__(self, messages: list[tuple[str, str]], attempt: int) -> str:
        system, human = messages[0][1], messages[1][1]
        if system == "alertas":
            return '{"largo":%d,"placa":"modelo"}' % len(human)
        return "sin respuesta" if len(human) % 4 == 0 else '```json\n{"score":%d}\n```' % (len(human) % 101)


def _prompts(spark: SparkSession) -> DataFrame:
    texts = {**dict.fromkeys([flows.NOTE_PROMPT], "notas"), "sistema_alertas_riesgos_prompt": "alertas"}
    texts["auditoria_calidad_metricas_prompt"] = "calidad"
    return spark.createDataFrame([("v4", k, t) for k, t in texts.items()], "version string, key string, text string")


@query(
    "audited_cases",
    f"WITH n0 AS ({NOTES_SQL}), "
    + sb.CASES_CTE.replace(f"notes AS ({NOTES_SQL})", f"notes AS (SELECT * REPLACE ({BLANKED} AS observacion) FROM n0)")
    + f", h AS (SELECT *, length('<ENTRADA>' || chr(10) || {entry_sql(rq.CASE_FIELDS)} || chr(10) || '</ENTRADA>') AS n FROM cases) "
    "SELECT numero_siniestro, CASE WHEN observaciones_unidas <> '' THEN 'modelo' ELSE placa END AS placa, "
    "CASE WHEN observaciones_unidas <> '' THEN CAST(n AS VARCHAR) END AS largo, CASE WHEN observaciones_unidas <> '' AND n % 4 > 0 THEN CAST(n % 101 AS VARCHAR) END AS score, "
    "CASE WHEN observaciones_unidas <> '' AND n % 4 = 0 THEN 'Fallo ejecución LLM o parseo JSON' END AS error_b, "
    "CASE WHEN observaciones_unidas = '' THEN 'sin datos' END AS resumen, CASE WHEN observaciones_unidas = '' THEN '0' ELSE CAST(total_eventos AS VARCHAR) END AS total FROM h",
)
def audited_cases(spark: SparkSession, folder: str) -> DataFrame:
    source = notes(spark, folder).withColumn("observacion", F.expr(BLANKED))
    cases = tl.unify_cases(source, "ord")
    done = flows.audit_cases(cases, _prompts(spark), "v4", CaseClient(), shared_path(spark, "case-answers"), **NO_WAIT)
    at = lambda key, name: F.try_element_at("resultado", F.lit(key)).alias(name)
    return done.select(
        "numero_siniestro",
        at("placa", "placa"),
        at("largo", "largo"),
        at("score", "score"),
        at("error_PROMPT_B", "error_b"),
        at("resumen_general", "resumen"),
        at("total_eventos", "total"),
    )


class SeenClient:
    """Says of every part that it was seen."""

    def __call__(self, messages: list[tuple[str, str]], attempt: int) -> str:
        return '{"visto":1,"ultima":%d}' % messages[1][1].count("</ENTRADA>")


@query(
    "audited_cases_in_parts",
    f"WITH n0 AS ({NOTES_SQL}), "
    + sb.CASES_CTE.replace(f"notes AS ({NOTES_SQL})", f"notes AS (SELECT * REPLACE ({BLANKED} AS observacion) FROM n0)")
    + " SELECT numero_siniestro, placa, CASE WHEN eventos_no_vacios > 0 THEN '1' END AS visto, CASE WHEN eventos_no_vacios = 0 THEN 'sin datos' END AS resumen, "
    "CASE WHEN eventos_no_vacios = 0 THEN '0' ELSE CAST(total_eventos AS VARCHAR) END AS total FROM cases",
)
def audited_cases_in_parts(spark: SparkSession, folder: str) -> DataFrame:
    """One audit per case, however many parts its text is asked in."""
    source = notes(spark, folder).withColumn("observacion", F.expr(BLANKED))
    cases = tl.unify_cases(source, "ord", part_bytes=100)
    done = flows.audit_cases(cases, _prompts(spark), "v4", SeenClient(), shared_path(spark, "part-answers"), **NO_WAIT)
    at = lambda key, name: F.try_element_at("resultado", F.lit(key)).alias(name)
    return done.select("numero_siniestro", "placa", at("visto", "visto"), at("resumen_general", "resumen"), at("total_eventos", "total"))


class NoteClient:
    def __call__(self, messages: list[tuple[str, str]], attempt: int) -> str:
        size = len(messages[1][1])
        return '{"clasificacion":"cambio_estado","confianza":0.5,"calidad_comunicativa_score":%d}' % (size % 101)


@query(
    "classified_notes",
    "SELECT ord, numero_aviso, 'cambio_estado' AS clasificacion, CAST(length('Observación: ' || coalesce(observacion, 'None')) % 101 AS INTEGER) AS calidad_comunicativa_score, "
    f"0.5::DOUBLE AS confianza FROM (SELECT ord, nullif(numero_aviso, '') AS numero_aviso, nullif({sb.strip('observacion')}, '') AS observacion FROM ({NOTES_SQL}))",
)
def classified_notes(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "note-answers")
    done = flows.classify_notes(notes(spark, folder), _prompts(spark), "v4", NoteClient(), path, **NO_WAIT)
    return done.select("ord", "numero_aviso", "clasificacion", "calidad_comunicativa_score", "confianza")
