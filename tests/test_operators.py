"""Operators on small fixtures: skew paths, folds, upsert, inference, sources and ingest."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.functions import jsonish as js
from caselog.functions import text as tx
from caselog.operators import answers as an
from caselog.operators import audit as au
from caselog.operators import contact as co
from caselog.operators import content as ct
from caselog.operators import notes as nt
from caselog.operators import phases as ph
from caselog.operators import requests as rq
from caselog.operators import skew
from caselog.operators import tables as tb
from caselog.operators import timeline as tl
from caselog.plans import answer_queries, case_queries, catalog, flows, registry
from caselog.plans.inputs import notes, responses
from caselog.sources import readers, writers
from caselog.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_previous_in_key_is_the_same_for_hot_keys(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS k", "id", "id * 7 % 11 AS v")
    plain = skew.previous_in_key(df, ["k"], ["id"], ["v"], budget=10**9)
    hot = skew.previous_in_key(df, ["k"], ["id"], ["v"], budget=100)
    every = skew.previous_in_key(df, ["k"], ["id"], ["v"], heavy=skew.Heavy(None, False))
    assert rows(plain) == rows(hot) == rows(every)


def test_hot_chunks_carry_across_boundaries(spark, monkeypatch):
    monkeypatch.setattr(skew, "CHUNK_BITS", 4)
    df = spark.range(2000).selectExpr("'one' AS k", "id", "id % 13 AS v")
    plain = skew.previous_in_key(df, ["k"], ["id"], ["v"], budget=10**9)
    assert rows(plain) == rows(skew.previous_in_key(df, ["k"], ["id"], ["v"], budget=5))


def test_lookup_joins_hot_and_null_keys(spark):
    left = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE CAST(id AS STRING) END AS k", "id")
    right = spark.range(0, 900, 2).selectExpr("CAST(id AS STRING) AS k", "id * 2 AS w").unionByName(
        spark.createDataFrame([("hot", -1)], "k string, w long")
    )
    assert rows(skew.lookup(left, right, ["k"], budget=50)) == rows(left.join(right, "k", "left"))


def test_timeline_parts_join_to_the_whole(spark, monkeypatch):
    monkeypatch.setattr(tl, "TEXT_CHUNK_BITS", 3)
    text = "CASE WHEN id % 5 > 0 AND id % 40 <> 7 AND NOT id BETWEEN 900 AND 2000 THEN concat('e', id) END AS evento"
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 40 AS STRING) END AS k", "id", text)
    whole = {r.k: (r.texto, r.total) for r in tl.timeline_parts(df, ["k"], ["id"]).collect()}
    parts = tl.timeline_parts(df, ["k"], ["id"], part_bytes=100).orderBy("k", "parte").collect()
    assert len(parts) > 2 * len(whole) == 2 * len({p.k for p in parts})
    for key, (text, total) in whole.items():
        mine = [p for p in parts if p.k == key]
        assert [p.parte for p in mine] == list(range(mine[0].partes)) and {p.total for p in mine} == {total}
        assert " | ".join(p.texto for p in mine) == text
        assert len(mine) == 1 or all(p.texto for p in mine)
        pieces = 0
        for p in mine:
            assert p.piezas_antes == pieces
            pieces += len(p.texto.split("|"))


def test_no_window_of_a_timeline_holds_text(spark, folder):
    cases = tl.unify_cases(notes(spark, folder), "ord", part_bytes=100)
    plan = cases._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan or all("evento" not in line for line in plan.splitlines() if "Window" in line)


def test_shards_partition_rows_exactly(spark):
    df = spark.range(103).selectExpr("(id * 37) % 103 AS id")
    placed = tb.shards(df, ["id"], 10).collect()
    assert sorted(r.ordinal for r in placed) == list(range(103))
    assert all(r.id == r.ordinal and r.shard_id == r.ordinal // 11 for r in placed)


def test_shards_allow_more_slices_than_rows(spark):
    assert {r.shard_id for r in tb.shards(spark.range(3), ["id"], 10).collect()} == {0, 1, 2}
    assert tb.shards(spark.range(0), ["id"], 10).count() == 0


@pytest.mark.parametrize(("total", "workers", "size", "expected"), [(100, 16, 0, 7), (3, 16, 0, 1), (100, 1, 500, 100), (100, 1, 9, 9)])
def test_chunk_size(total, workers, size, expected):
    assert tb.chunk_size(total, workers, size) == expected


def test_results_do_not_depend_on_partitions_or_order(spark, folder):
    source = notes(spark, folder)
    mixed = source.repartition(7, "observacion")
    before = rows(tl.unify_cases(source, "ord"))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(tl.unify_cases(mixed, "ord")) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_column_names_and_types(spark):
    table = {
        "NIT TALLER": ["1", "-5", "2147483647"],
        "2nd col": ["2147483648", " 1 ", ""],
        "--": ["9223372036854775808", "1", "2"],
        "a": ["1", "2.5", "nan"],
        "A": ["1", "0", "1"],
        "b": ["true", "1", "no"],
        "c": ["2025-01-13", "13/01/2025", ""],
        "d": ["08:30", "08:30:15", ""],
        "e": ["2025-01-13T08:30:00.123Z", "2025-01-13 08:30", ""],
        "f": ["a", "1", ""],
        "g": ["", " ", None],
        "h": ["1_000", "7", ""],
    }
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame(list(zip(*table.values())), ", ".join(f"`{c}` string" for c in table))
        found = [(r.columna, r.tipo) for r in tb.column_types(df).orderBy("posicion").collect()]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    assert found == [
        ("nit_taller", "INTEGER"), ("col_2nd_col", "BIGINT"), ("col", "TEXT"), ("a", "DOUBLE PRECISION"), ("a_2", "INTEGER"),
        ("b", "BOOLEAN"), ("c", "DATE"), ("d", "TIME"), ("e", "TIMESTAMP"), ("f", "TEXT"), ("g", "TEXT"), ("h", "INTEGER"),
    ]
    assert list(tb.unique_names(["a", "a_2", "a", "a", "a_2"])) == ["a", "a_2", "a_3", "a_4", "a_2_2"]


def test_parse_ladder(spark):
    raws = {
        "plain": '{"clasificacion":"cambio_estado","confianza_clasificacion":0.9}',
        "fenced": '```JSON\n{"a":1}\n```',
        "around": 'texto {"a":1} fin',
        "comma": '{"a":1,}',
        "smart": "{“a”:1}",
        "literal": "{'a': True}",
        "list": '[{"a":1}]',
        "twice": '{"a":1,"a":2}',
        "empty": "",
        "null": None,
        "cut": '{"a":1',
    }
    df = spark.createDataFrame(list(raws.items()), "name string, raw string")
    basic = {r.name: r.parse_tier for r in an.parse_basic(df).collect()}
    robust = {r.name: r.parse_tier for r in an.parse_robust(df).collect()}
    assert basic == {"plain": 1, "fenced": 1, "around": 2, "comma": 0, "smart": 0, "literal": 0, "list": 0, "twice": 1, "empty": 0, "null": 0, "cut": 0}
    assert robust == {"plain": 1, "fenced": 2, "around": 2, "comma": 2, "smart": 2, "literal": 3, "list": 0, "twice": 1, "empty": 0, "null": 0, "cut": 0}
    assert all(robust[name] > 0 for name, tier in basic.items() if tier > 0)


def test_fold_keeps_core_of_failed_attempts_only_with_parity(spark):
    good_core = '{"clasificacion":"sin_cambio","confianza":0.5,"calidad_comunicativa_score":40,"explicacion_calidad":5}'
    df = spark.createDataFrame([("r", "NOTA", 1, good_core), ("r", "NOTA", 2, "nada")], "request_id string, step string, attempt int, raw string")
    checked = an.validate(an.parse_basic(df))
    kept, plain = an.fold_attempts(checked).first(), an.fold_attempts(checked, parity=False).first()
    assert (kept.clasificacion, kept.calidad_comunicativa_score, kept.explicacion_calidad) == ("sin_cambio", 40, an.UNUSABLE_QUALITY_TEXT)
    assert (plain.clasificacion, plain.calidad_comunicativa_score) == ("sin_clasificar", 0)


def test_folding_a_fold_changes_nothing(spark, folder):
    checked = an.validate(an.parse_basic(responses(spark, folder)))
    once = an.fold_attempts(checked)
    again = checked.join(once.select("request_id", "intento_valido"), "request_id").where(
        F.col("attempt") == F.coalesce("intento_valido", "attempt")
    )
    columns = ["request_id", *an.CORE, *an.QUALITY]
    assert rows(an.fold_attempts(again).select(columns)) == rows(once.select(columns))


def test_non_finite_confidence_is_clamped(spark):
    raws = [('{"clasificacion":"sin_cambio","confianza":%s}' % v,) for v in ("NaN", "1.7", "-2", "true", '"0.25"', '"x"')]
    df = spark.createDataFrame(raws, "raw string").selectExpr("'r' AS request_id", "1 AS attempt", "raw")
    found = [r.confianza for r in an.validate(an.parse_basic(df)).collect()]
    assert found == [1.0, 1.0, 0.0, 1.0, 0.25, None]


def test_upsert_twice_is_upsert_once(spark):
    schema = "numero_aviso long, numero_siniestro long, fecha_observacion string, usuario string, v string"
    target = spark.createDataFrame([(1, 1, "a", "u", "old"), (2, 1, "a", "u", "keep")], schema)
    source = spark.createDataFrame([(1, 1, "a", "u", "x", 0), (1, 1, "a", "u", "y", 1), (3, 1, "a", "u", "new", 2)], schema + ", n int")
    once = tb.upsert(target, source, "n")
    values = {r.numero_aviso: (r.v, r.accion, r.copias) for r in once.collect()}
    assert values == {1: ("y", "actualizada", 2), 2: ("keep", "igual", 0), 3: ("new", "insertada", 1)}
    twice = tb.upsert(once.drop("accion", "copias"), source, "n")
    assert rows(twice.drop("accion", "copias")) == rows(once.drop("accion", "copias"))


def test_inference_retries_and_resumes(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def client(messages, attempt):
        calls.add(1)
        if messages[1][1] == "boom":
            raise RuntimeError("no")
        return "{}" if messages[1][1] == "good" or attempt == 5 else "bad"

    asked = spark.createDataFrame(
        [("1", "S", "k", "good"), ("1", "S", "k", "good"), ("2", "S", "k", "boom"), ("3", "S", "none", "other")],
        "request_id string, step string, system_key string, human string",
    )
    prompts = spark.createDataFrame([("v", "k", "sys"), ("v", "k", "sys"), ("w", "k", "x")], "version string, key string, text string")
    options = {"backoff": lambda attempt: 0.0, "prompts": prompts, "version": "v"}
    path = str(tmp_path / "r")
    count = lambda df: {(r.request_id, r.n) for r in df.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    first = rq.answer_pending(asked, path, client, **options)
    assert count(first) == {("1", 1), ("2", 3), ("3", 3)}
    assert calls.value == 7
    assert first.where("request_id = '2'").first().error == "RuntimeError: no"
    assert count(rq.answer_pending(asked, path, client, **options)) == {("1", 1), ("2", 6), ("3", 5)}
    rq.answer_pending(asked, path, client, most_attempts=6, **options)
    assert calls.value == 12


def test_prompts_join_alike_beyond_the_broadcast_limit(spark, monkeypatch):
    asked = spark.createDataFrame([(i, "a" if i % 3 else None if i % 2 else "b") for i in range(30)], "i int, system_key string")
    prompts = spark.createDataFrame([("v", "a", " A "), ("v", "b", " "), ("w", "c", "C")], "version string, key string, text string")
    small = rows(rq.with_prompts(asked, prompts, "v").select("i", "system"))
    monkeypatch.setattr(rq, "PROMPT_ROWS_MAX", 0)
    assert rows(rq.with_prompts(asked, prompts, "v").select("i", "system")) == small


def test_strict_template_is_json():
    assert list(json.loads(rq.STRICT_TEMPLATE))[:2] == ["resumen_general", "informatividad_score_0a100"]


def test_header_match():
    columns = ["Número  Aviso", "ESTADO AVISO", "observaciones_unidas"]
    assert nt.header_match(columns, ["numero aviso"]) == "Número  Aviso"
    assert nt.header_match(columns, ["siniestro"]) is None
    assert nt.header_match(["ESTADO AVISO"], ["aviso"]) is None
    assert nt.header_match(["EL ESTADO AVISO", "ESTADO AVISO"], ["aviso"], partial=True) == "ESTADO AVISO"
    assert nt.header_match(["PREAVISO"], ["aviso"], partial=True) is None


def test_phrases_start_at_words(spark):
    texts = ["Se solicita autorización a la aseguradora", "Se empieza pintura", "envío internacional", "nueva cita", "citación", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r.c for r in df.select(ct.classify(F.col("t")).alias("c")).collect()]
    assert found == ["comunicacion_interna", "cambio_estado", "sin_clasificar", "comunicacion_cliente", "sin_clasificar", "sin_clasificar"]


def test_silence_around_the_only_contact(spark):
    rows = [(1, "2024-01-01", True), (1, "2024-03-01", False), (2, "2024-01-01", False), (2, "2024-01-20", True), (3, "2024-01-01", True), (3, "2024-01-02", False)]
    notes = spark.createDataFrame(rows, "caso int, d string, c boolean").withColumn("dia", F.to_date("d"))
    alerts = co.contact_alerts(co.contact_metrics(notes, ["caso"], "dia", F.col("c")))
    found = {r.caso: (r.silencio_maximo_dias, r.codigo_visual, r.nivel_alerta) for r in alerts.collect()}
    assert found == {1: (60, "ROJO", "CRITICA"), 2: (19, "ROJO", "CRITICA"), 3: (1, "VERDE", "SIN_ALERTA")}


def test_long_lists_stay_whole(spark):
    raw = '{"evidencias":[%s]}' % ",".join(f'"{i}"' for i in range(40))
    parsed = an.parse_robust(spark.createDataFrame([("r", 1, raw)], "request_id string, attempt int, raw string"))
    assert len(au.sanitize(parsed).first().evidencias) == 40
    assert len(au.sanitize(parsed, most_evidence=10).first().evidencias) == 10


def test_note_csv_needs_its_column(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text('PLACA,OBSERVACION\nA1,"x\ny"\n', encoding="utf-8")
    with pytest.raises(ValueError, match="NOMBRE TALLER"):
        readers.read_note_csv(spark, str(path))
    assert readers.read_note_csv(spark, str(path), required=[]).first().OBSERVACION == "x\ny"


def test_empty_exports(spark, tmp_path):
    empty = spark.createDataFrame([], "evidencias array<string>")
    writers.write_audit_csv(empty, str(tmp_path / "a"))
    assert spark.read.option("header", True).csv(str(tmp_path / "a")).first().info == "sin registros"
    with pytest.raises(ValueError):
        writers.write_notes_csv(empty, str(tmp_path / "b"))
    assert writers.table_name("/x/Mi Tabla.csv") == "mi_tabla"


def test_load_modes(spark, tmp_path):
    raw = spark.createDataFrame([("1", "x")], "a string, b string")
    path = str(tmp_path / "t")
    writers.load_table(raw, path, "fail")
    writers.load_table(raw, path, "append")
    assert spark.read.parquet(path).count() == 2
    writers.load_table(raw, path, "replace")
    assert spark.read.parquet(path).dtypes == [("a", "int"), ("b", "string")]
    with pytest.raises(Exception, match="exist"):
        writers.load_table(raw, path, "fail")


def test_ingest_takes_each_chunk_once(spark, tmp_path):
    record = T.StructType([T.StructField("v", T.LongType())])
    inbox = tmp_path / "in"
    inbox.mkdir()
    payload = {"request_id": "r", "chunk_index": 0, "registros": [{"v": 1}, {"v": 1}]}
    (inbox / "1.json").write_text(json.dumps(payload) + "\n" + json.dumps(payload) + "\n")
    paths = [str(inbox), str(tmp_path / "table"), str(tmp_path / "state")]
    assert ingest.ingest_chunks(spark, *paths, record).count() == 2
    (inbox / "2.json").write_text(json.dumps(payload) + "\n" + json.dumps(payload | {"chunk_index": 1}) + "\n")
    assert ingest.ingest_chunks(spark, *paths, record).count() == 4


def test_stalled_phase_is_the_same_on_the_hot_path(spark, folder):
    phased = notes(spark, folder).select("caso", "ord", "dia", ph.phase_number(F.col("observacion")).alias("fase"))
    plain = ph.stalled_phases(phased, ["caso"], ["ord"], "fase", "dia")
    assert rows(plain) == rows(ph.stalled_phases(phased, ["caso"], ["ord"], "fase", "dia", budget=3))


def test_merge_keeps_protected_keys(spark):
    df = spark.range(1).select(F.create_map(F.lit("placa"), F.lit("A")).alias("b"), F.create_map(F.lit("placa"), F.lit("B")).alias("l"))
    pick = lambda protected: df.select(au.merge_answers(F.col("b"), [F.col("l")], protected)).first()[0]
    assert pick([]) == {"placa": "B"} and pick(["placa"]) == {"placa": "A"}


@pytest.mark.parametrize("name", ["unified_cases", "gap_statistics", "contact_metrics", "phase_sequence", "keyed_upsert", "document_repeats", "attempt_fold"])
def test_plans_never_gather_all_rows_in_one_task(name, spark, folder):
    plan = catalog.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_audit_of_a_case_in_parts_keeps_what_each_part_says(spark, tmp_path):
    class PartClient:
        """Answers every part by its own text: the first event raises the alert, the rest do not."""

        def __call__(self, messages, attempt):
            first = "evento 000" in messages[1][1]
            if messages[0][1] == "alertas":
                alert = {"detectada": first, "nivel_riesgo": "ALTO" if first else "BAJO"}
                return json.dumps({"alerta": alert, "nivel_alerta": "ROJO" if first else "VERDE"})
            remarks = ["Nota/Supuesto: una", "Nota/Supuesto: primera" if first else "Nota/Supuesto: otra"]
            return json.dumps({"score_final_0a100": 100 if first else 50, "observaciones": remarks, "total_observaciones": 3})

    pieces = [" | ".join(f"2025-01-01 - evento {i:03}" for i in part) for part in (range(3), range(3, 4))]
    names = "nit_taller nombre_taller numero_aviso numero_siniestro placa usuario rol_analista".split()
    rows = [(*names, 4, 4, at, 2, 3 * at, text) for at, text in enumerate(pieces)]
    schema = ", ".join(f"{n} string" for n in names) + ", total_eventos long, eventos_no_vacios long, parte long, partes long, piezas_antes long, observaciones_unidas string"
    prompts = spark.createDataFrame(
        [("v4", k, t) for k, t in zip(flows.STEP_PROMPTS.values(), ("alertas", "calidad"))], "version string, key string, text string"
    )
    cases = spark.createDataFrame(rows, schema)
    done = flows.audit_cases(cases, prompts, "v4", PartClient(), str(tmp_path / "answers"), backoff=lambda attempt: 0.0)
    (result,) = [r["resultado"] for r in done.collect()]
    assert json.loads(result["alerta"]) == {"detectada": True, "nivel_riesgo": "ALTO"} and result["nivel_alerta"] == "ROJO"
    assert (result["score_final_0a100"], result["total_observaciones"]) == ("88", "6")
    assert json.loads(result["observaciones"]) == ["Nota/Supuesto: una", "Nota/Supuesto: primera", "Nota/Supuesto: otra"]


def test_rows_on_their_way_through_python_weigh_their_text(spark):
    """Rows whose arguments are null all wait in one queue, however many a task has."""
    df = spark.createDataFrame([('{"a":1}',), ("{'a': True}",), (None,)], "raw string")
    parsed = an.parse_robust(df)
    sent = re.findall(r"_(?:nfkc|literals|literal_json)\((\w+)", parsed._jdf.queryExecution().optimizedPlan().toString())
    assert sent and "CASE" not in sent
    assert [r.parse_tier for r in parsed.collect()] == [1, 3, 0]


def test_tasks_that_sort_attempts_have_a_bounded_share_of_the_orders(spark, folder, monkeypatch):
    monkeypatch.setattr(registry, "DEALT_ROWS", 100)
    steps = answer_queries._steps(spark, folder)
    sizes = [r["count"] for r in steps.groupBy(F.spark_partition_id()).count().collect()]
    orders = spark.read.parquet(f"{folder}/orders.parquet").count()
    assert sum(sizes) == 4 * orders and max(sizes) <= 2 * 100 * 4


def test_no_cell_is_cast_to_find_that_it_does_not_fit(spark):
    """A failed cast costs more than all other tests of a cell."""
    values = ["-2147483648", "2147483648", "-9223372036854775808", "9223372036854775808", "0" * 30 + "7", "9" * 20, "1_000", "+5"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    bits = df.select(tx.let(F.col("v"), tb._type_bits).alias("b"))
    sizes = [r.b & (tb.SMALL | tb.LONG) for r in bits.collect()]
    both = tb.SMALL | tb.LONG
    assert sizes == [both, tb.LONG, tb.LONG, 0, both, 0, both, both]
    plan = bits._jdf.queryExecution().optimizedPlan().toString()
    assert "length(" in plan.split("cast(")[0]
    cells = spark.createDataFrame([(v,) for v in [" a ", "\u00a0b", "c\x1f", "é\u2003", "d", "", None, " "]], "v string")
    assert [r[0] for r in cells.select(tx.strip_cell(F.col("v"))).collect()] == ["a", "b", "c", "é", "d", "", None, ""]


def test_cases_are_gathered_once_for_requests_and_results(spark, folder):
    """The result reads the written cases; what it took to gather them is not repeated."""
    for name in ("audited_cases", "audited_cases_in_parts"):
        files = catalog.QUERIES[name](spark, folder).inputFiles()
        assert files and not any("events.parquet" in f for f in files)


def test_big_cases_come_from_their_chunks_alone(spark, folder, monkeypatch):
    """Their notes are cleaned once to be put in order; descriptors and counts take no reading of their own."""
    whole = tl.unify_cases(notes(spark, folder), "ord")
    expected = rows(whole)
    for module, name, value in ((skew, "HEAVY_LIST_MAX", 10), (tl, "TASK_EVENTS", 0), (tl, "TEXT_CHUNK_BITS", 3)):
        monkeypatch.setattr(module, name, value)
    big = tl.unify_cases(notes(spark, folder), "ord")
    assert big.columns == whole.columns and rows(big) == expected
    assert not any("events.parquet" in f for f in big.inputFiles())


def test_all_cells_are_cleaned_in_methods_that_java_compiles(spark, folder):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        blanked = notes(spark, folder).withColumn("observacion", F.expr(case_queries.BLANKED))
        plan = nt.clean_cells(nt.canonical_columns(blanked, keep=["ord"]))._jdf.queryExecution()
        shown = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) <= 8000


def test_a_cell_loses_one_leading_equals_sign(spark):
    cells = [None, "", "=", "==a", " \xa0=a= ", "a=b", "=\na", "\n==\t"]
    df = spark.createDataFrame([(c,) for c in cells], "c string").select(tx.clean_cell(F.col("c")))
    assert [r[0] for r in df.collect()] == ["", "", "", "=a", "a=", "a=b", "\na", "="]


def test_cleaning_of_notes_is_generated_as_methods_that_java_compiles(spark, folder):
    """Java only interprets methods of more than 8,000 bytes."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.QUERIES["unified_cases"](spark, folder)._jdf.queryExecution()
        shown = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) <= 8000


def test_sanitize_reads_numbers_without_lambdas_and_only_the_kinds_it_needs(spark, folder):
    """A lambda's inside is interpreted row by row, and types of other keys take a read of all their values."""
    plan = catalog.QUERIES["sanitized_audits"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(array(" not in plan and "MapType(StringType,VariantType" not in plan
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("sanitized_audits", "final_score_fallback"):
            plan = catalog.QUERIES[name](spark, folder)._jdf.queryExecution()
            shown = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan, "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
            assert sizes and max(sizes) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_sanitize_tells_values_from_texts_that_look_like_them(spark):
    key = "informatividad_score_0a100"
    answers = {
        f'{{"{key}":true,"evidencias":"[1]","score_final_0a100":"0"}}': (1, 0, ["[1]"]),
        f'{{"{key}":"true","evidencias":[1,null,"x"],"score_final_0a100":0}}': (0, 0, ["1", "x"]),
        f'{{"{key}":50,"evidencias":5,"score_final_0a100":false}}': (50, 10, []),
        f'{{"{key}":"50","evidencias":"5","score_final_0a100":"false"}}': (50, 0, ["5"]),
        f'{{"{key}":"\\"62.5\\"","evidencias":null,"score_final_0a100":"[]"}}': (62, 0, []),
        f'{{"{key}":1e999,"evidencias":{{"a":1}},"score_final_0a100":[]}}': (0, 0, []),
        f'{{"{key}":-7,"evidencias":" dos ","score_final_0a100":true}}': (0, 1, ["dos"]),
    }
    rows = spark.createDataFrame([(text,) for text in answers], "raw string")
    read = au.sanitize(an.parse_robust(rows)).select("raw", key, "score_final_0a100", "evidencias").collect()
    assert {r[0]: tuple(r[1:]) for r in read} == answers


def test_text_that_cannot_be_json_is_not_read_as_such(spark):
    texts = ["{'a':1}", '{"a":1 , }', '{ "a":{} } ', "{ }", '{"a":"{,}"}', "{,}", '{"a":1} x', '{"a":1},{"b":2}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    likely = [r[0] for r in rows.select(F.col("t").rlike(js.JSON_OBJECT)).collect()]
    assert likely == [False, False, True, True, True, False, False, True]
    assert [r["m"] for r in js.with_object(rows, "t", "m").collect()] == [None, None, {"a": "{}"}, {}, {"a": "{,}"}, None, None, None]
    others = ["nulo", "no es json", " null ", "-Infinity", "-1.5e3", '"a', "[1", "[1] x", "[{}]", '"a"', "1,2", "NaN", "true"]
    rows = spark.createDataFrame([(t,) for t in others], "t string")
    assert [r[0] for r in rows.select(js.is_other_json(F.col("t"))).collect()] == [
        False, False, True, True, True, False, False, False, True, True, False, True, True,
    ]
