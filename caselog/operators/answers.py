"""Model answers of the note step: extraction, parsing, validation and attempt folding."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import jsonish as js
from caselog.functions import numbers as nb
from caselog.functions import text as tx
from caselog.schemas import CLASSES, LAST_CLASS, CLASSIFIED

MAX_ATTEMPTS = 3

# Texts stored when an answer gives none.
NO_EXPLANATION = "sin explicación"
NO_QUALITY_TEXT = "Sin evaluación de calidad comunicativa."
UNUSABLE_QUALITY_TEXT = "La salida no fue utilizable."
UNPARSED_TEXT = "no se pudo parsear salida LLM"
NO_PROMPT_TEXT = "prompt no encontrado"


def with_basic_candidate(df: DataFrame, raw: str, name: str, wanted: str | None = None) -> DataFrame:
    """Adds the text to read: compatibility form, no control characters, content of the first fence.

    One projection per step, as each step uses the one before several times. Null where the flag
    `wanted` is not true.
    """
    flag = None if wanted is None else F.col(wanted)
    step = df.withColumn("_form", js.nfkc(F.col(raw), flag))
    form = F.col("_form") if flag is None else F.when(flag, F.col("_form"))
    step = step.withColumn("_bare", F.trim(js.drop_control(form)))
    return step.withColumn(name, tx.strip_blank(js.unfence(F.col("_bare")))).drop("_form", "_bare")


def parse_basic(responses: DataFrame) -> DataFrame:
    """Adds `answer` (map, null when unreadable), `parse_tier` and the text that was read.

    Tier 1 is the whole text, tier 2 the span between the outer braces. Text that is JSON but not
    an object stops at once, as reading a list or a number never leads to the second tier.
    """
    df = js.with_object(with_basic_candidate(responses, "raw", "_text"), "_text", "_whole")
    retry = F.col("_whole").isNull() & ~js.is_other_json(F.col("_text"))
    df = df.withColumn("_span", F.when(retry, js.braces(F.col("_text"))))
    df = js.with_object(df, "_span", "_inner")
    tier = F.when(F.col("_whole").isNotNull(), 1).when(F.col("_inner").isNotNull(), 2).otherwise(0)
    text = F.when(F.col("_whole").isNotNull(), F.col("_text")).when(F.col("_inner").isNotNull(), F.col("_span"))
    found = js.pinned(df, answer=F.coalesce("_whole", "_inner"), parse_tier=tier, parsed_text=text)
    return found.drop("_text", "_whole", "_span", "_inner")


def with_robust_candidate(df: DataFrame, raw: str, name: str, wanted: str) -> DataFrame:
    """Adds the brace span of the cleaned text, or the raw text; plain quotes, no dangling commas.

    Null where the flag `wanted` is not true.
    """
    step = with_basic_candidate(df, raw, "_basic", wanted).withColumn("_span", js.braces(F.col("_basic")))
    step = step.withColumn("_rest", F.when(F.col(wanted), F.coalesce(F.col("_span"), F.col(raw))))
    fixed = js.drop_trailing_commas(js.plain_quotes(F.col("_rest")))
    return step.withColumn(name, tx.strip_blank(js.drop_control(fixed))).drop("_basic", "_span", "_rest")


def parse_robust(responses: DataFrame) -> DataFrame:
    """Raw text first, then the repaired span, then a Python literal; only leftovers are worked on."""
    one, two, three = (js.has_object(f"{name}_items") for name in ("_one", "_two", "_three"))
    df = js.with_items(responses, "raw", js.TEXTS, "_one_items")
    df = js.pinned(df, _one=js.only_object("_one_items"), _open=~one & ~js.is_other_json(F.col("raw"))).drop("_one_items")
    df = js.with_items(with_robust_candidate(df, "raw", "_cand", "_open"), "_cand", js.TEXTS, "_two_items")
    left = ~two & ~js.is_other_json(F.col("_cand")) & F.col("_cand").rlike(js.OBJECT_SHAPE)
    found = {"_two": js.only_object("_two_items"), "_left": F.coalesce(left, F.lit(False))}
    df = js.pinned(df, **found, _cand=F.col("_cand")).drop("_two_items")
    literal = js.literal_json(F.coalesce("_cand", "raw"), F.col("_left"))
    df = df.withColumn("_any", literal).withColumn("_lit", F.when(F.col("_left"), F.col("_any")))
    df = js.with_items(df, "_lit", js.TEXTS, "_three_items")
    tier = F.when(F.col("_one").isNotNull(), 1).when(F.col("_two").isNotNull(), 2).when(three, 3).otherwise(0)
    text = (
        F.when(F.col("_one").isNotNull(), F.col("raw"))
        .when(F.col("_two").isNotNull(), F.col("_cand"))
        .when(three, F.col("_lit"))
    )
    answer = F.coalesce(F.col("_one"), F.col("_two"), js.only_object("_three_items"))
    found = js.pinned(df, answer=answer, parse_tier=tier, parsed_text=text)
    return found.drop("_one", "_open", "_cand", "_two", "_left", "_any", "_lit", "_three_items")


def _value(key: str) -> Column:
    return F.try_element_at(F.col("answer"), F.lit(key))


def _kind(key: str) -> Column:
    return F.coalesce(F.col("_kinds")[key], F.lit("STRING"))


# The keys of a note answer whose JSON type is asked for.
TYPED = [
    "clasificacion",
    "explicacion_clasificacion",
    "explicacion",
    "confianza_clasificacion",
    "confianza",
    "calidad_comunicativa_score",
    "explicacion_calidad",
    "elementos_faltantes",
]


def _falsy(value: Column, kind: Column) -> Column:
    """Missing, null, empty text, false, zero, empty list or empty object."""
    return (
        value.isNull()
        | (value == "")
        | ((kind != "STRING") & (value.isin("false", "[]", "{}") | (nb.to_double(value) == 0)))
    )


def _number(value: Column, kind: Column) -> Column:
    """Number of a JSON number, numeric text, true or false."""
    truth = F.when(value == "true", 1.0).when(value == "false", 0.0)
    return F.when(kind == "BOOLEAN", truth).otherwise(nb.to_double(value))


def validate(parsed: DataFrame) -> DataFrame:
    """Adds the normalized fields, `core_valid`, `valid` and `reject_reason` per attempt."""
    df = js.with_kinds(parsed, "parsed_text", "_kinds", TYPED)
    # Each expression is built once: a plan is judged anew in every round.
    value, kind = cache(_value), cache(_kind)
    falsy = cache(lambda key: _falsy(value(key), kind(key)))
    number = cache(lambda key: _number(value(key), kind(key)))
    not_text = cache(lambda key: ~falsy(key) & (kind(key) != "STRING"))
    has = lambda key: F.coalesce(F.map_contains_key("answer", F.lit(key)), F.lit(False))
    label = F.when(kind("clasificacion") == "STRING", tx.strip_blank(value("clasificacion")))
    explanation = (
        F.when(~falsy("explicacion_clasificacion"), value("explicacion_clasificacion"))
        .when(~falsy("explicacion"), value("explicacion"))
        .otherwise(F.lit(NO_EXPLANATION))
    )
    bad_explanation = not_text("explicacion_clasificacion") | (
        falsy("explicacion_clasificacion") & not_text("explicacion")
    )
    confidence = (
        F.when(has("confianza_clasificacion"), number("confianza_clasificacion"))
        .when(has("confianza"), number("confianza"))
        .otherwise(F.lit(0.0))
    )
    reason = (
        F.when(F.col("parse_tier") == 0, "sin_json")
        .when(F.size("answer") == 0, "objeto_vacio")
        .when(~F.coalesce(label.isin(CLASSES), F.lit(False)), "clasificacion")
        .when(bad_explanation, "explicacion")
        .when(confidence.isNull(), "confianza")
    )
    quality = F.when(kind("calidad_comunicativa_score") == "BOOLEAN", number("calidad_comunicativa_score").cast("string")).otherwise(
        value("calidad_comunicativa_score")
    )
    quality_text = F.coalesce(
        F.nullif(
            tx.strip_blank(F.when(~falsy("explicacion_calidad"), value("explicacion_calidad"))), F.lit("")
        ),
        F.lit(NO_QUALITY_TEXT),
    )
    missing = value("elementos_faltantes")
    missing_kind = kind("elementos_faltantes")
    listed = F.transform(F.from_json(missing, "array<string>"), lambda e: F.coalesce(tx.strip_blank(e), F.lit("None")))
    missing_list = (
        F.when(falsy("elementos_faltantes"), F.array().cast("array<string>"))
        .when(missing_kind.startswith("ARRAY"), F.filter(listed, lambda e: e != ""))
        .when(missing_kind.startswith("OBJECT"), F.array().cast("array<string>"))
        .when(missing_kind == "BOOLEAN", F.array(F.initcap(missing)))
        .otherwise(F.array(missing))
    )
    late = F.when(F.coalesce(not_text("explicacion_calidad"), F.lit(False)), "explicacion_calidad")
    checked = js.pinned(
        df,
        clasificacion=label,
        explicacion=tx.strip_blank(explanation),
        confianza=nb.clamp(confidence, 0.0, 1.0),
        calidad_comunicativa_score=nb.score_0_100(quality),
        explicacion_calidad=quality_text,
        elementos_faltantes=missing_list,
        _core=reason,
        _late=late,
    )
    return checked.withColumns(
        {
            "core_valid": F.col("_core").isNull(),
            "reject_reason": F.coalesce("_core", "_late"),
            "valid": F.col("_core").isNull() & F.col("_late").isNull(),
        }
    ).drop("_kinds", "_core", "_late")


def judged(responses: DataFrame) -> DataFrame:
    """Note responses read and validated: the gate of the note step."""
    return validate(parse_basic(responses))


CORE = ["clasificacion", "explicacion", "confianza", "calidad_comunicativa_score"]
QUALITY = ["explicacion_calidad", "elementos_faltantes"]


def fold_attempts(validated: DataFrame, parity: bool = True) -> DataFrame:
    """One row per request: the first valid attempt, else defaults.

    With `parity`, when no attempt is fully valid the class, confidence and score of the last
    attempt whose core was valid are kept, next to the default quality text.
    """
    struct = lambda columns: F.struct(*[F.col(c) for c in columns])
    attempt = F.col("attempt")
    folded = validated.groupBy("request_id").agg(
        F.min_by(F.when(F.col("valid"), struct(CORE + QUALITY)), F.when(F.col("valid"), attempt)).alias("_best"),
        F.max_by(F.when(F.col("core_valid"), struct(CORE)), F.when(F.col("core_valid"), attempt)).alias("_core"),
        F.min(F.when(F.col("valid"), attempt)).alias("intento_valido"),
        F.max(attempt).alias("intentos"),
    )
    core = lambda c: F.coalesce(*([F.col(f"_best.{c}")] + ([F.col(f"_core.{c}")] if parity else [])))
    return folded.select(
        "request_id",
        F.coalesce(core("clasificacion"), F.lit(LAST_CLASS)).alias("clasificacion"),
        F.coalesce(core("explicacion"), F.lit(UNPARSED_TEXT)).alias("explicacion"),
        F.coalesce(core("confianza"), F.lit(0.0)).alias("confianza"),
        F.coalesce(core("calidad_comunicativa_score"), F.lit(0)).alias("calidad_comunicativa_score"),
        F.coalesce("_best.explicacion_calidad", F.lit(UNUSABLE_QUALITY_TEXT)).alias("explicacion_calidad"),
        F.coalesce("_best.elementos_faltantes", F.array().cast("array<string>")).alias("elementos_faltantes"),
        "intento_valido",
        "intentos",
    )


def classified_notes(notes: DataFrame, folded: DataFrame) -> DataFrame:
    """Notes with their folded answers; a note without prompt or answer gets the defaults.

    `notes` holds request_id and `con_prompt`, whether a prompt was found.
    """
    from caselog.operators.requests import rows_with_answers

    joined = rows_with_answers(notes, folded)
    no_prompt = ~F.col("con_prompt")
    text = F.when(no_prompt, F.lit(NO_PROMPT_TEXT)).otherwise(
        F.coalesce(F.col("explicacion"), F.lit(UNPARSED_TEXT))
    )
    values = {
        "clasificacion": F.when(no_prompt, F.lit(LAST_CLASS)).otherwise(
            F.coalesce("clasificacion", F.lit(LAST_CLASS))
        ),
        "explicacion": text,
        "explicacion_clasificacion": text,
        "confianza": F.when(no_prompt, 0.0).otherwise(F.coalesce("confianza", F.lit(0.0))),
        "calidad_comunicativa_score": F.when(no_prompt, 0).otherwise(
            F.coalesce("calidad_comunicativa_score", F.lit(0))
        ),
        "explicacion_calidad": F.when(no_prompt, F.lit(NO_QUALITY_TEXT)).otherwise(
            F.coalesce("explicacion_calidad", F.lit(UNUSABLE_QUALITY_TEXT))
        ),
        "elementos_faltantes": F.coalesce("elementos_faltantes", F.array().cast("array<string>")),
    }
    values["confianza_clasificacion"] = values["confianza"]
    kept = [c for c in joined.columns if c not in values]
    return joined.select(*kept, *[v.alias(c) for c, v in values.items()])


def error_records(failed: DataFrame, error: str = "error") -> DataFrame:
    """Default note records for failed rows; identity columns are kept, the error is the reason."""
    fields = CLASSIFIED.fieldNames()
    fixed = {
        "clasificacion": F.lit(LAST_CLASS),
        "explicacion": F.col(error),
        "confianza": F.lit(0.0),
        "elementos_faltantes": F.array().cast("array<string>"),
    }
    columns = []
    for field in CLASSIFIED.fields:
        if field.name in fixed:
            columns.append(fixed[field.name].alias(field.name))
        elif field.name in failed.columns:
            columns.append(F.col(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    extra = [F.col(c) for c in failed.columns if c not in fields and c != error]
    return failed.select(*extra, *columns)


def parse_statistics(validated: DataFrame) -> DataFrame:
    """Attempts by step, tier and reject reason."""
    return validated.groupBy("step", "parse_tier", "reject_reason").agg(
        F.count(F.lit(1)).alias("respuestas"), F.max("attempt").alias("intento_max")
    )
