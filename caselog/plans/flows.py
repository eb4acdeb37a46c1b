"""The two audits from end to end: notes to classified notes, cases to audited cases."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselog.operators import answers as an
from caselog.operators import audit as au
from caselog.operators import notes as nt
from caselog.operators import requests as rq
from caselog.schemas import NOTE_HEADER
from caselog.session import written

# The catalog keys of the three prompts.
NOTE_PROMPT = "observaciones_clasificacion_prompt"
STEP_PROMPTS = {
    "PROMPT_A": "sistema_alertas_riesgos_prompt",
    "PROMPT_B": "auditoria_calidad_metricas_prompt",
}
EMPTY_CASE = "sin datos"


def classify_notes(
    notes: DataFrame, prompts: DataFrame, version: str, client: Any, path: str, **options: Any
) -> DataFrame:
    """Notes with class, confidence, quality score and missing elements.

    Responses are stored under `path` before they are read. Invalid and failed answers are asked again,
    in this run and in later ones. Notes without a prompt are never sent and keep the defaults.
    """
    cells = [c for c in [*NOTE_HEADER.values(), "estado_aviso"] if c in notes.columns]
    human = rq.note_text(F.col("observacion"))
    asked = nt.note_scalars(notes, cells).withColumns({"system_key": F.lit(NOTE_PROMPT), "step": F.lit("NOTA")})
    asked = rq.with_prompt_flag(asked, prompts, version).withColumn("human", human)
    asked = asked.withColumn("request_id", rq.request_id(F.col("step"), F.lit(version), human))
    ready = asked.where("con_prompt").select("request_id", "step", "system_key", "human")
    stored = rq.answer_pending(ready, path, client, prompts, version, accept=an.judged, **options)
    folded = an.fold_attempts(an.judged(stored))
    done = an.classified_notes(asked.drop("human", "step", "clasificacion", "system_key"), folded)
    return done.drop("request_id", "con_prompt")


def audit_cases(
    cases: DataFrame,
    prompts: DataFrame,
    version: str,
    client: Any,
    path: str,
    protected: list[str] = (),
    **options: Any,
) -> DataFrame:
    """One row per case with `resultado`: identity, alert answers and quality answers, later ones winning.

    Both steps get the same text, in several requests where a case comes in parts; the answers of the
    parts are folded key by key (`audit.fold_values`), weighted by their events, before the steps are merged. A step without a readable answer leaves its failure marker; a case
    without note text is not sent. The cases are gathered once and written to the shared folder, as requests,
    the count of hot texts and both kinds of result read them.
    """
    human = rq.case_text(cases)
    texts = written(cases.withColumn("request_id", F.when(
        F.col("observaciones_unidas") != "", rq.request_id(F.lit("CASO"), F.lit(version), human)
    )), "cases")
    steps = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(k).alias("system_key")) for s, k in STEP_PROMPTS.items()])
    asked = texts.where(F.col("request_id").isNotNull()).select(
        "request_id", human.alias("human"), F.explode(steps).alias("s")
    )
    ready = asked.select("request_id", "human", "s.*")
    stored = rq.answer_pending(ready, path, client, prompts, version, **options)
    answered = au.step_answers(an.parse_basic(stored))
    joined = rq.rows_with_answers(texts, answered)
    layers = F.array(*[F.col(s) for s in au.STEPS])
    single, several = joined.where("partes = 1"), joined.where("partes > 1")
    shape = [c for c in cases.columns if c not in ("parte", "piezas_antes", "observaciones_unidas")]
    one = single.select(*shape, "observaciones_unidas", "request_id", layers.alias("_layers"))
    weight = F.size(F.split("observaciones_unidas", r"\|"))
    answers = F.to_json(layers, {"ignoreNullFields": "false"})
    in_order = F.sort_array(F.collect_list(F.struct("parte", weight.alias("weight"), answers.alias("layers"))))
    many = several.groupBy(*shape).agg(in_order.alias("_parts"), F.first("request_id").alias("request_id"))
    read = F.transform(
        "_parts",
        lambda p: F.struct(p["weight"].alias("weight"), F.from_json(p["layers"], "array<map<string,string>>").alias("layers")),
    )
    folded = F.udf(au.fold_layers, "array<map<string,string>>")(read)
    many = many.select(*shape, F.lit(None).cast("string").alias("observaciones_unidas"), "request_id", folded.alias("_layers"))
    identity = {c: F.col(c).cast("string") for c in rq.CASE_FIELDS}
    base = F.create_map(*[part for name, value in identity.items() for part in (F.lit(name), value)])
    nothing = {c: v for c, v in identity.items() if c not in ("total_eventos", "observaciones_unidas")}
    nothing |= {"resumen_general": F.lit(EMPTY_CASE), "total_eventos": F.lit("0")}
    empty = F.create_map(*[part for name, value in nothing.items() for part in (F.lit(name), value)])
    merged = au.merge_all(base, F.col("_layers"), protected)
    result = F.when(F.col("request_id").isNull(), empty).otherwise(merged)
    return one.unionByName(many).select(*shape, "observaciones_unidas", result.alias("resultado"))
