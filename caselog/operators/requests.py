"""Building model requests, running a user-supplied client over them, and resuming."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import text as tx
from caselog.operators import answers as an
from caselog.operators import skew
from caselog.schemas import AUDIT_FLAT, CONFIDENCE, NOTE_HEADER, RESPONSES
from caselog.session import cut_lineage

CASE_FIELDS = [
    "nit_taller",
    "nombre_taller",
    "numero_aviso",
    "numero_siniestro",
    "placa",
    "usuario",
    "rol_analista",
    "total_eventos",
    "observaciones_unidas",
]
STRICT_FIELDS = CASE_FIELDS[2:]
PROMPT_ROWS_MAX, PROMPT_CHARS_MAX, PROMPT_SALTS = 1_000, 10_000_000, 64

STRICT_HEAD = (
    "TAREA:\n"
    "- Evalúa el caso usando solo lo que dice la ENTRADA.\n"
    "- Responde con un único objeto JSON con las claves de FORMATO_DE_SALIDA y nada más.\n\n"
)


def _output_format() -> str:
    """The flat audit record as a JSON object: the kind of value each key takes."""
    shown = {"string": "texto", "int": "entero de 0 a 100", "array<string>": ["texto"]}
    record = {f.name: shown[f.dataType.simpleString()] for f in AUDIT_FLAT.fields}
    record["confianza"] = " | ".join(CONFIDENCE)
    return json.dumps(record, ensure_ascii=False, indent=2)


STRICT_TEMPLATE = _output_format()


def note_record(df: DataFrame) -> Column:
    """The nine note columns under their file header, as a JSON object."""
    fields = [F.col(name).cast("string").alias(header) for header, name in NOTE_HEADER.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def note_text(observation: Column) -> Column:
    return F.concat(F.lit("Observación: "), F.coalesce(observation.cast("string"), F.lit("None")))


def entry_json(df: DataFrame, fields: list[str], null_as_text: bool = False) -> Column:
    """Case fields as indented JSON. Counts stay numbers, everything else is text or null.

    A part of a case says which of how many it is.
    """
    lines = []
    for name in fields:
        value = F.col(name)
        if name == "total_eventos":
            shown = value.cast("string")
        else:
            shown = tx.json_text(F.coalesce(value, F.lit("")) if null_as_text else value)
        lines.append(F.concat(F.lit(f'  "{name}": '), shown))
    if "partes" in df.columns:
        count = F.concat(F.lit('  "parte": '), F.col("parte") + 1, F.lit(',\n  "partes": '), F.col("partes"))
        lines.insert(-1, F.when(F.col("partes") > 1, count))
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))


def case_text(df: DataFrame) -> Column:
    return F.concat(F.lit("<ENTRADA>\n"), entry_json(df, CASE_FIELDS), F.lit("\n</ENTRADA>"))


def strict_case_text(df: DataFrame) -> Column:
    return F.concat(
        F.lit(STRICT_HEAD + "<ENTRADA>\n"),
        entry_json(df, STRICT_FIELDS, null_as_text=True),
        F.lit("\n</ENTRADA>\n\nFORMATO_DE_SALIDA:\n" + STRICT_TEMPLATE),
    )


def request_id(step: Column, system_key: Column, human: Column) -> Column:
    """Same step, prompt and text give the same id, so equal requests are asked once."""
    return F.sha2(F.concat_ws("\u0001", step, system_key, human), 256)


def prompt_texts(prompts: DataFrame, version: str) -> DataFrame:
    """system_key and system, one row per key; blank texts are null, the first of several is taken."""
    named = prompts.where((F.col("version") == version) & F.col("key").isNotNull())
    text = F.nullif(tx.strip_blank(F.col("text")), F.lit(""))
    return named.groupBy(F.col("key").alias("system_key")).agg(F.min(text).alias("system"))


def with_prompts(requests: DataFrame, prompts: DataFrame, version: str) -> DataFrame:
    """Adds the system text for `system_key`; null where the catalog has none.

    A catalog of up to PROMPT_ROWS_MAX keys and PROMPT_CHARS_MAX characters is broadcast. A larger one
    is joined with each key spread over PROMPT_SALTS rows, as most requests share a few keys.
    """
    catalog = prompt_texts(prompts, version)
    size = catalog.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("system")).alias("chars")).first()
    if size["n"] <= PROMPT_ROWS_MAX and (size["chars"] or 0) <= PROMPT_CHARS_MAX:
        return requests.join(F.broadcast(catalog), "system_key", "left")
    salts = F.explode(F.sequence(F.lit(0), F.lit(PROMPT_SALTS - 1))).alias("_salt")
    salted = requests.withColumn("_salt", F.pmod(F.xxhash64(*requests.columns), F.lit(PROMPT_SALTS)).cast("int"))
    return salted.join(catalog.select("*", salts), ["system_key", "_salt"], "left").drop("_salt")


def with_prompt_flag(rows: DataFrame, prompts: DataFrame, version: str) -> DataFrame:
    """Adds `con_prompt`: whether the catalog has a text for `system_key`. The text stays behind."""
    known = prompts.withColumn("text", F.when(~tx.is_blank(F.col("text")), F.lit("x")))
    return with_prompts(rows, known, version).withColumn("con_prompt", F.col("system").isNotNull()).drop("system")


def distinct_requests(requests: DataFrame, key: list[str] = ("request_id", "step")) -> DataFrame:
    """One row per request and step; copies of a text are folded before the shuffle."""
    rest = [F.first(c).alias(c) for c in requests.columns if c not in key]
    return requests.groupBy(*key).agg(*rest).select(*requests.columns)


def readable(responses: DataFrame) -> DataFrame:
    """Adds `valid`: the answer is a JSON object."""
    return an.parse_basic(responses).withColumn("valid", F.col("answer").isNotNull())


def pending(
    requests: DataFrame,
    judged: DataFrame,
    key: list[str] = ("request_id", "step"),
    most_attempts: int | None = None,
) -> DataFrame:
    """Requests without a valid response, with the number of their next attempt.

    `judged` holds stored responses with `attempt` and `valid`; errors and invalid answers leave a
    request pending until it has had `most_attempts`.
    """
    state = judged.groupBy(*key).agg(F.max("attempt").alias("_tried"), F.bool_or("valid").alias("_done"))
    attempt = (F.coalesce("_tried", F.lit(0)) + 1).cast("int").alias("attempt")
    open_ = requests.join(state, list(key), "left").where(~F.coalesce("_done", F.lit(False)))
    todo = open_.select(*requests.columns, attempt)
    return todo if most_attempts is None else todo.where(F.col("attempt") <= most_attempts)


#: Gets the messages as (role, text) and the attempt's number, returns the answer's text.
Client = Callable[[list[tuple[str, str]], int], str]


def run_inference(requests: DataFrame, client: Client, slots: int | None = None) -> DataFrame:
    """One call per row of request_id, step, attempt, system and human; errors are rows too.

    `slots` caps how many calls run at once. The client is called while the plan runs, so write the
    result before reading it twice.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                raw, error = None, None
                try:
                    raw = str(client([("system", row.system), ("human", row.human)], row.attempt))
                except Exception as failure:  # the client may raise anything
                    error = f"{type(failure).__name__}: {failure}"
                rows.append((row.request_id, row.step, row.attempt, raw, error))
            yield pd.DataFrame(rows, columns=RESPONSES.fieldNames())

    placed = requests.repartition(slots, "request_id") if slots else requests
    return placed.select("request_id", "step", "attempt", "system", "human").mapInPandas(ask, RESPONSES)


def answer_pending(
    requests: DataFrame,
    path: str,
    client: Client,
    prompts: DataFrame | None = None,
    version: str = "",
    accept: Callable[[DataFrame], DataFrame] = readable,
    attempts: int = 3,
    most_attempts: int | None = None,
    backoff: Callable[[int], float] = lambda attempt: 2.0 * 2 ** (attempt - 1),
    slots: int | None = None,
) -> DataFrame:
    """Ask until every request has a valid response, in at most `attempts` rounds; return all responses.

    A round asks each pending request once and stores its responses before the next one judges them
    with `accept`, which adds `valid` to responses. So a lost task repeats its calls of one round only,
    invalid answers are asked again, and a later run asks again what failed before, up to
    `most_attempts` in all. With `prompts`, the text of `system_key` is attached to the distinct
    pending requests just before they are sent; without, `system` comes with the requests. The pending
    requests of a round are written once to the shared folder, and each response is judged once.
    """
    spark = requests.sparkSession
    spark.createDataFrame([], RESPONSES).write.mode("append").parquet(path)
    told = "system" if prompts is None else "system_key"
    asked = distinct_requests(requests.select("request_id", "step", told, "human"))
    earlier = spark.read.schema(RESPONSES).parquet(path)
    # Without earlier responses there is nothing to judge.
    judged = earlier.withColumn("valid", F.lit(False)) if earlier.isEmpty() else accept(earlier)
    todo = cut_lineage(pending(asked, judged, most_attempts=most_attempts))
    for number in range(1, attempts + 1):
        if number > 1:
            todo = cut_lineage(_still_pending(todo, spark.read.schema(RESPONSES).parquet(path), accept, most_attempts))
            if todo.isEmpty():
                break
            time.sleep(backoff(number - 1))
        told_all = todo if prompts is None else with_prompts(todo, prompts, version)
        told_all = told_all.withColumn("system", F.coalesce("system", F.lit("")))
        run_inference(told_all, client, slots).write.mode("append").parquet(path)
    return spark.read.schema(RESPONSES).parquet(path)


def _still_pending(
    asked: DataFrame, stored: DataFrame, accept: Callable[[DataFrame], DataFrame], most_attempts: int | None
) -> DataFrame:
    """The requests of a round that it did not settle, with their next attempt; only its responses are judged."""
    key = ["request_id", "step", "attempt"]
    judged = accept(stored.join(asked.select(*key), key, "left_semi"))
    settled = judged.where("valid").select("request_id", "step").distinct()
    left = asked.join(settled, ["request_id", "step"], "left_anti")
    todo = left.withColumn("attempt", (F.col("attempt") + 1).cast("int"))
    return todo if most_attempts is None else todo.where(F.col("attempt") <= most_attempts)


def rows_with_answers(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Folded answers back to every row that asked; a text asked by many rows is handled apart."""
    return skew.lookup(rows, answers, ["request_id"], "left")
