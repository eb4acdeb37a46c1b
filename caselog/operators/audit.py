"""Case audits: answer sanitizing, dual-step merge, typed extraction and contract checks."""

from __future__ import annotations

import json
import math
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.functions import jsonish as js
from caselog.functions import numbers as nb
from caselog.functions import text as tx
from caselog.schemas import AUDIT_FLAT, CLASSES, CONFIDENCE, SCORE_PARTS

WEIGHTS = dict(zip(SCORE_PARTS, (30, 25, 20, 15, 10)))

# The audit record stored when nothing could be evaluated.
DEFAULT_SUMMARY = "No fue posible evaluar."
DEFAULT_JUSTIFICATION = "Sin datos"
DEFAULT_REMARK = "Nota/Supuesto: salida por defecto."
EMPTY_CASE_SUMMARY = "sin datos"
EMPTY_CASE_REMARK = "Nota/Supuesto: no se encontraron observaciones para evaluar."
ERROR_SUMMARY = "error"
ERROR_REMARK = "Nota/Supuesto: error en worker."
STEP_FAILURE = "Fallo ejecución LLM o parseo JSON"
STEPS = ["PROMPT_A", "PROMPT_B"]


def _value(key: str) -> Column:
    return F.try_element_at(F.col("answer"), F.lit(key))


def _kind(key: str) -> Column:
    return F.coalesce(F.col("_kinds")[key], F.lit("STRING"))


def _has(key: str) -> Column:
    return F.coalesce(F.map_contains_key("answer", F.lit(key)), F.lit(False))


def _text(key: str, default: str) -> Column:
    """Value as text; an explicit null reads None, a missing key takes the default."""
    return F.coalesce(_value(key), F.when(_has(key), F.lit("None")).otherwise(F.lit(default)))


def _list(key: str, value: Column, default: list[str], most: int | None) -> Column:
    kind = _kind(key)
    parsed = F.filter(F.from_json(value, "array<string>"), lambda e: e.isNotNull())
    single = F.when((kind == "STRING") & ~tx.is_blank(value), F.array(tx.strip_blank(value)))
    items = F.when(kind.startswith("ARRAY"), parsed).otherwise(single)
    empty = F.array().cast("array<string>")
    fallback = F.array(*[F.lit(d) for d in default]) if default else empty
    whole = F.when(value.isNotNull(), F.coalesce(items, empty)).when(_has(key), empty).otherwise(fallback)
    return whole if most is None else F.slice(whole, 1, most)


def _score_text(key: str, value: Column) -> Column:
    truth = F.when(value == "true", "1").otherwise("0")
    return F.when(_kind(key) == "BOOLEAN", truth).otherwise(value)


def _kind_matters(numbers: list[str], lists: list[str]) -> Column:
    """False where each value reads alike whether it was a text or not: no flag, no zero, no list.

    Such answers need not be read a second time for the types of their values.
    """
    flags = [F.col(f"_{key}").isin("true", "false") for key in numbers]
    no_text = [F.col(f"_{key}").rlike(r'^[\[{"+\-0-9tfnNI]') for key in lists]
    final = F.col("_score_final_0a100")
    cases = [*flags, *no_text, final.isin("[]", "{}"), final.contains("0")]
    return reduce(Column.__or__, [F.coalesce(case, F.lit(False)) for case in cases])


def mean_score(parts: list[Column]) -> Column:
    """Unweighted mean of the sub-scores, half-even."""
    total = sum((p.cast("long") for p in parts[1:]), parts[0].cast("long"))
    return F.bround(total.cast("decimal(20,2)") / F.lit(len(parts)), 0).cast("int")


def sanitize(parsed: DataFrame, most_evidence: int | None = None, most_remarks: int | None = None) -> DataFrame:
    """Complete audit record per answer; keys outside the record stay in the map `extras`.

    Lists are kept whole unless a limit is asked for.
    """
    scores = [f"{p}_score_0a100" for p in SCORE_PARTS]
    numbers, lists = [*scores, "score_final_0a100"], ["evidencias", "observaciones"]
    texts = {"resumen_general": DEFAULT_SUMMARY} | {f"{p}_justificacion": DEFAULT_JUSTIFICATION for p in SCORE_PARTS}
    # One projection per step, as each step uses the one before several times. Numbers and texts are read next
    # to the lists: a projection with a lambda is generated as many small methods. Elsewhere they would make one
    # of more than 8,000 bytes, and Java only interprets such a method.
    df = parsed.withColumns({f"_{key}": _value(key) for key in numbers + lists})
    df = js.with_kinds(df.withColumn("_asked", F.when(_kind_matters(numbers, lists), F.col("parsed_text"))), "_asked", "_kinds", numbers + lists)
    final, typed = F.col("_score_final_0a100"), _kind("score_final_0a100") != "STRING"
    read = {f"_{key}": _score_text(key, F.col(f"_{key}")) for key in numbers}
    empty = final.isNull() | (final == "") | (typed & final.isin("false", "[]", "{}"))
    df = df.withColumns(read | {"_no_final": F.coalesce(empty, F.lit(False))})
    known = AUDIT_FLAT.fieldNames()
    read = {f"_{key}": nb.to_double(F.col(f"_{key}")) for key in numbers}
    read["_evidencias"] = _list("evidencias", F.col("_evidencias"), [], most_evidence)
    read["_observaciones"] = _list("observaciones", F.col("_observaciones"), [DEFAULT_REMARK], most_remarks)
    read |= {key: _text(key, default) for key, default in texts.items()}
    read["_confianza"] = F.lower(_text("confianza", "baja"))
    read["extras"] = F.map_filter("answer", lambda k, _: ~k.isin(known))
    df = df.withColumns(read | {"_typed": typed})
    zero = F.coalesce(F.col("_typed") & (final == 0), F.lit(False))
    df = df.withColumns({key: nb.score_of(F.col(f"_{key}")) for key in scores} | {"_no_final": F.col("_no_final") | zero})
    clean = js.pinned(
        df,
        **{key: F.col(key) for key in scores},
        **{key: F.col(key) for key in texts},
        score_final_0a100=F.when(F.col("_no_final"), mean_score([F.col(c) for c in scores])).otherwise(nb.score_of(final)),
        evidencias=F.col("_evidencias"),
        observaciones=F.col("_observaciones"),
        confianza=F.when(F.col("_confianza").isin(CONFIDENCE), F.col("_confianza")).otherwise(F.lit("baja")),
        extras=F.col("extras"),
    )
    return clean.drop("_kinds", "_no_final", "_typed", "_asked", "_confianza", *[f"_{key}" for key in numbers + lists])


def _default_columns(overrides: dict[str, Column]) -> list[Column]:
    empty = F.array().cast("array<string>")
    base = {"resumen_general": F.lit(DEFAULT_SUMMARY), "score_final_0a100": F.lit(0)}
    for part in SCORE_PARTS:
        base[f"{part}_score_0a100"] = F.lit(0)
        base[f"{part}_justificacion"] = F.lit(DEFAULT_JUSTIFICATION)
    base |= {"evidencias": empty, "observaciones": F.array(F.lit(DEFAULT_REMARK)), "confianza": F.lit("baja")}
    base |= overrides
    return [base[name].alias(name) for name in AUDIT_FLAT.fieldNames()]


def empty_case_records(cases: DataFrame) -> DataFrame:
    """Default audit of cases without any note text, one row per case."""
    empty = cases.where((F.col("eventos_no_vacios") == 0) & (F.col("parte") == 0))
    remarks = {
        "resumen_general": F.lit(EMPTY_CASE_SUMMARY),
        "observaciones": F.array(F.lit(EMPTY_CASE_REMARK)),
    }
    return empty.select(
        "numero_aviso",
        "numero_siniestro",
        "placa",
        F.lit(0).cast("long").alias("total_eventos"),
        *_default_columns(remarks),
    )


def failed_case_records(failed: DataFrame, error: str = "error") -> DataFrame:
    """Default audit of cases whose processing failed; identity columns are kept."""
    literal = {f"{p}_justificacion": F.lit(ERROR_SUMMARY) for p in SCORE_PARTS}
    literal["informatividad_justificacion"] = F.concat(F.lit("error: "), F.col(error))
    literal |= {"resumen_general": F.lit(ERROR_SUMMARY), "observaciones": F.array(F.lit(ERROR_REMARK))}
    identity = [c for c in failed.columns if c != error and c not in AUDIT_FLAT.fieldNames()]
    return failed.select(*identity, *_default_columns(literal))


def step_answers(parsed: DataFrame, steps: list[str] = STEPS) -> DataFrame:
    """Per request, one answer map per step: first readable attempt, or the failure marker."""
    columns = []
    for step in steps:
        usable = (F.col("step") == step) & F.col("answer").isNotNull()
        best = F.min_by(F.when(usable, F.struct("answer")), F.when(usable, F.col("attempt")))
        failure = F.create_map(F.lit(f"error_{step}"), F.lit(STEP_FAILURE))
        columns.append(F.coalesce(best["answer"], failure).alias(step))
    return parsed.groupBy("request_id").agg(*columns)


def merge_answers(base: Column, layers: list[Column], protected: list[str] = ()) -> Column:
    """Shallow merge of text maps, later keys win; protected keys keep the base value."""
    merged = base
    for layer in layers:
        added = F.coalesce(layer, F.create_map().cast("map<string,string>"))
        if protected:
            added = F.map_filter(added, lambda k, _: ~k.isin(list(protected)))
        merged = F.map_concat(_without(merged, added), added)
    return merged


def merge_all(base: Column, layers: Column, protected: list[str] = ()) -> Column:
    """merge_answers over a list of layers."""
    empty = F.create_map().cast("map<string,string>")
    start = F.map_concat(base, empty)
    return F.aggregate(layers, start, lambda merged, layer: merge_answers(merged, [layer], protected))


# Labels from harmless to grave; of several parts the gravest counts.
GRAVITY = {
    label: rank
    for rank, labels in enumerate(
        (("ninguno", "ninguna", "sin_alerta"), ("verde", "🟢", "bajo", "baja"), ("amarillo", "🟡", "medio", "media", "moderado", "moderada"),
         ("naranja", "🟠"), ("rojo", "🔴", "alto", "alta"), ("critico", "crítico", "critica", "crítica", "muy alto"))
    )
    for label in labels
}
LEVEL = re.compile(r"^(nivel_(riesgo|alerta|riesgo_queja)|estado_semaforo|codigo_visual)$")
MEAN = re.compile(r"score|porcentaje|promedi[oa]|por_semana|^confianza")
SUM = re.compile(r"^(total_|observaciones_)|_(halladas|detectadas)$")
NONE_BUT_ALL = ("secuencia_logica",)


def fold_values(key: str, values: list[tuple[Any, int]]) -> Any:
    """One value for a key that several parts of a case answered, each with its weight.

    Flags hold if any part's does, levels take the gravest, scores and shares the mean by weight, counts
    the sum, least and greatest numbers and dates their own; objects are folded by key, lists are joined
    without repeats, and different texts stand one after the other. Confidence takes the lowest label.
    """
    given = [(v, w) for v, w in values if v is not None]
    kept = [v for v, _w in given]
    if not kept:
        return None
    if all(isinstance(v, dict) for v in kept):
        names = dict.fromkeys(name for v in kept for name in v)
        return {name: fold_values(name, [(v[name], w) for v, w in given if name in v]) for name in names}
    if any(isinstance(v, list) for v in kept):
        items = [x for v in kept for x in (v if isinstance(v, list) else [v])]
        return list({json.dumps(x, sort_keys=True): x for x in items}.values())
    if all(isinstance(v, bool) for v in kept):
        return all(kept) if key in NONE_BUT_ALL else any(kept)
    numbers = all(isinstance(v, (int, float)) for v in kept)
    if numbers and SUM.search(key):
        return sum(kept)
    if all(v == kept[0] for v in kept):
        return kept[0]
    if numbers and MEAN.search(key):
        mean = sum(v * w for v, w in given) / sum(w for _v, w in given)
        return round(mean) if all(isinstance(v, int) for v in kept) else mean
    least = "minima" in key or "primera" in key
    if numbers or key.startswith("fecha_"):
        return (min if least else max)(kept, key=lambda v: (not isinstance(v, str), v) if numbers else str(v))
    ranks = [GRAVITY.get(str(v).strip().lower()) for v in kept]
    if None not in ranks and (LEVEL.search(key) or key == "confianza"):
        pick = min if key == "confianza" else max
        return kept[ranks.index(pick(ranks))]
    texts = [v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in kept]
    return " | ".join(dict.fromkeys(texts))


def _read(text: str | None) -> Any:
    """A map's value: objects, lists, numbers and flags as such, all else as text."""
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        return text
    return text if isinstance(value, float) and not math.isfinite(value) else value


def fold_layers(parts: list) -> list[dict[str, str | None]]:
    """One map per step from those of all parts, in order; `parts` hold their weight and layers."""
    folded = []
    for step in range(max((len(p["layers"]) for p in parts), default=0)):
        mine = [((p["layers"][step] or {}), max(1, p["weight"])) for p in parts]
        result = {}
        for name in dict.fromkeys(name for layer, _w in mine for name in layer):
            raw = [layer[name] for layer, _w in mine if name in layer]
            value = fold_values(name, [(_read(layer[name]), w) for layer, w in mine if name in layer])
            same = [text for text in raw if text is not None and _read(text) == value]
            text = value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)
            result[name] = same[0] if same else text
        folded.append(result)
    return folded


def _without(entries: Column, others: Column) -> Column:
    return F.map_filter(entries, lambda k, _: ~F.map_contains_key(others, k))


def with_layer(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds any answer as a mergeable map: object keys, list positions, or the text as llm_raw."""
    read = js.with_object(df, text, "_object").withColumn("_items", F.from_json(F.col(text), "array<string>"))
    raw, items = F.col(text), F.col("_items")
    positions = F.transform(F.sequence(F.lit(0), F.size(items) - 1), lambda i: i.cast("string"))
    empty = F.create_map().cast("map<string,string>")
    is_list = raw.rlike(r"^\s*\[") & (F.size(items) >= 0)
    layer = (
        F.when(raw.isNull() | (is_list & (F.size(items) == 0)), empty)
        .when(is_list, F.map_from_arrays(positions, items))
        .otherwise(F.coalesce(F.col("_object"), F.create_map(F.lit("llm_raw"), raw)))
    )
    return read.withColumn(name, layer).drop("_object", "_items")


def typed_answer(text: Column, schema: T.StructType) -> Column:
    """Nested answer with a fixed schema; unknown keys are ignored, unreadable text is null."""
    return F.from_json(text, schema)


def leaves(schema: T.StructType, root: str) -> list[Column]:
    """Every leaf of a nested struct as a column named by its path below the root."""
    columns: list[Column] = []

    def walk(struct: T.StructType, path: list[str]) -> None:
        for field in struct.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType, here)
            else:
                columns.append(F.col(".".join([root, *here])).alias("__".join(here)))

    walk(schema, [])
    return columns


def _as_given(df: DataFrame, numbers: dict[str, Column], texts: dict[str, Column], lists: list[str] = ()) -> DataFrame:
    read = {name: nb.to_double(value) for name, value in numbers.items()} | texts
    for key in lists:
        items = F.when(_kind(key).startswith("ARRAY"), F.from_json(_value(key), "array<string>"))
        read[key] = F.filter(items, lambda e: e.isNotNull())
    return js.pinned(df, **read).drop("_kinds")


def audit_as_given(parsed: DataFrame) -> DataFrame:
    """The flat audit answer in its types, neither clamped nor completed: what the contract is checked on."""
    df = js.with_kinds(parsed, "parsed_text", "_kinds", ["evidencias", "observaciones"])
    scores = [f"{p}_score_0a100" for p in SCORE_PARTS] + ["score_final_0a100"]
    texts = ["resumen_general", "confianza", *[f"{p}_justificacion" for p in SCORE_PARTS]]
    return _as_given(df, {k: _value(k) for k in scores}, {k: _value(k) for k in texts}, ["evidencias", "observaciones"])


def note_as_given(parsed: DataFrame) -> DataFrame:
    """The note answer in its types, neither clamped nor completed."""
    numbers = {
        "confianza": F.coalesce(_value("confianza_clasificacion"), _value("confianza")),
        "calidad_comunicativa_score": _value("calidad_comunicativa_score"),
    }
    texts = {
        "clasificacion": _value("clasificacion"),
        "explicacion": F.coalesce(_value("explicacion_clasificacion"), _value("explicacion")),
        "explicacion_calidad": _value("explicacion_calidad"),
    }
    return _as_given(parsed, numbers, texts)


def _words_between(name: str, low: int, high: int) -> Column:
    return tx.let(tx.word_count(F.col(name)), lambda n: n.between(low, high))


def note_rules() -> dict[str, Column]:
    """Contract of the note answer, each rule true where it holds."""
    return {
        "clase": F.col("clasificacion").isin(CLASSES),
        "confianza_0_1": F.col("confianza").between(0, 1),
        "calidad_0_100": F.col("calidad_comunicativa_score").between(0, 100),
        "explicacion_5_25": _words_between("explicacion", 5, 25),
        "calidad_texto_20_60": _words_between("explicacion_calidad", 20, 60),
    }


def audit_rules(summary_low: int = 50, summary_high: int = 150) -> dict[str, Column]:
    """Contract of the flat audit answer, each rule true where it holds."""
    rules: dict[str, Column] = {}
    for part in SCORE_PARTS:
        rules[f"{part}_0_100"] = F.col(f"{part}_score_0a100").between(0, 100)
        rules[f"{part}_15_80"] = _words_between(f"{part}_justificacion", 15, 80)
    formula = nb.weighted([(F.col(f"{p}_score_0a100"), w) for p, w in WEIGHTS.items()])
    rules["final_0_100"] = F.col("score_final_0a100").between(0, 100)
    rules["final_formula"] = F.col("score_final_0a100") == formula
    rules["resumen_palabras"] = _words_between("resumen_general", summary_low, summary_high)
    rules["confianza"] = F.col("confianza").isin(CONFIDENCE)
    rules["prefijo_nota"] = F.forall("observaciones", lambda e: e.rlike("^(Recomendación:|Nota/Supuesto:)"))
    rules["evidencia_con_fecha"] = F.forall("evidencias", lambda e: e.rlike(r"^\d{4}-\d{2}-\d{2}: .+"))
    return rules


def contract_report(answers: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """regla, revisados, incumplidos: one aggregation pass, then one row per rule."""
    holds = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    counted = answers.agg(
        F.count(F.lit(1)).alias("revisados"),
        *[F.count_if(~rule).alias(name) for name, rule in holds.items()],
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("regla"), F.col(n).alias("incumplidos")) for n in holds])
    return counted.select("revisados", F.explode(pairs).alias("r")).select("r.*", "revisados")
