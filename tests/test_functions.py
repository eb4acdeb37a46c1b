"""Text, date, number and JSON expressions on hand-made values."""

import datetime as d

import pytest
from pyspark.sql import functions as F

from caselog.functions import dates as dt
from caselog.functions import jsonish as js
from caselog.functions import numbers as nb
from caselog.functions import text as tx
from caselog.operators import audit as au
from caselog.operators import content as ct
from caselog.operators import gaps as gp


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, values, expression, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(expression(F.col("v"))).collect()]


def test_clean_cell_drops_one_equals_sign_after_strip(spark):
    values = ["  =1001 ", "==a", None, " x\t", "= b"]
    assert apply(spark, values, tx.clean_cell) == ["1001", "=a", "", "x", " b"]


def test_first_of_list(spark):
    values = ["[1001]", " ['a', 'b'] ", "[]", "[x", " z ", ""]
    assert apply(spark, values, tx.first_of_list) == ["1001", "a", "[]", "[x", "z", ""]
    assert apply(spark, [" ", "[7]"], lambda c: tx.first_of_list(c, True)) == [None, "7"]


def test_pipe_safe_and_words(spark):
    assert apply(spark, ["a|b\n c", None], tx.pipe_safe) == ["a / b c", ""]
    assert apply(spark, ["uno  dos\ttres", " ", None], tx.word_count) == [3, 0, 0]
    odd = ["\x1c a\x1fb", "a\x85b", "\u3000x\u3000", "… – ", "", "\u200b x"]
    assert apply(spark, odd, tx.word_count) == [2, 2, 1, 2, 0, 2]


def test_fold_removes_accents(spark):
    assert apply(spark, ["LATONERÍA ñ Ç"], tx.fold) == ["latoneria n c"]


def test_timeline_dates(spark):
    values = ["2025/01/13 2:18:43 PM", "2025-1-3 4:05:06", "2025-02-30", "13/01/2025"]
    found = apply(spark, values, dt.timeline_ts)
    assert found == [d.datetime(2025, 1, 13, 14, 18, 43), d.datetime(2025, 1, 3, 4, 5, 6), None, None]


def test_audit_dates_prefer_day_first(spark):
    values = ["03/04/2025", "12/31/2025", "2025-01-13T10:11:12", "2025/01/13 2:18:43 PM", ""]
    assert apply(spark, values, dt.audit_date) == ["2025-04-03", "2025-12-31", "2025-01-13", None, None]


def test_business_days_match_a_calendar_walk(spark):
    start = d.date(2024, 1, 1)
    pairs = [(start + d.timedelta(a), start + d.timedelta(a + n)) for a in range(8) for n in range(0, 40, 3)]
    df = spark.createDataFrame(pairs, "a date, b date")
    for row in df.withColumn("n", dt.business_days(F.col("a"), F.col("b"))).collect():
        days = [row.a + d.timedelta(i) for i in range(1, (row.b - row.a).days + 1)]
        assert row.n == sum(day.weekday() < 5 for day in days)


def test_scores_round_half_even_and_clamp(spark):
    values = ["74.5", "75.5", "90%", None, "150", "-3", "nan", "inf", "1d", " 12 ", "1e1"]
    assert apply(spark, values, nb.score_0_100) == [74, 76, 0, 0, 100, 0, 0, 0, 0, 12, 10]


def test_weighted_score_has_no_float_ties(spark):
    df = spark.createDataFrame([(50, 50, 50, 50, 55), (51, 50, 50, 50, 52)], "a int, b int, c int, d int, e int")
    total = nb.weighted([(F.col(n), w) for n, w in zip("abcde", au.WEIGHTS.values())])
    assert [r[0] for r in df.select(total).collect()] == [50, 50]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"a":1,"b":null}', {"a": "1", "b": None}),
        ('{"a":1,"a":2}', {"a": "2"}),
        ('{"a":1} tail', None),
        ('{"a":1},{"b":2}', None),
        ("[1]", None),
        ("{'a':1}", None),
        ("{}", {}),
        ("", None),
        (None, None),
    ],
)
def test_only_one_strict_object_is_read(spark, text, expected):
    df = js.with_object(column(spark, [text]), "v", "m")
    assert df.first()["m"] == expected


def test_kinds_and_other_json(spark):
    df = js.with_kinds(column(spark, ['{"a":1,"b":"x","c":null,"d":[1],"e":true}']), "v", "k")
    kinds = df.first()["k"]
    assert kinds["b"] == "STRING" and kinds["e"] == "BOOLEAN" and kinds["d"].startswith("ARRAY")
    assert apply(spark, ["[1]", "5", '"x"', "null", '{"a":1}', "abc", None], js.is_other_json) == [
        True, True, True, True, False, False, False,
    ]


def test_nfkc_and_literals(spark):
    assert apply(spark, ["n.º…", "plain", None], js.nfkc) == ["n.o...", "plain", None]
    values = ["{'a': True, 'b': (1, 2)}", "[1]", "{'a'", None]
    assert apply(spark, values, js.literal_json) == ['{"a": true, "b": [1, 2]}', None, None, None]


def test_lights_bands_and_tiers(spark):
    assert apply(spark, [8, 7, 4, 3], gp.time_light, "int") == ["ROJO", "AMARILLO", "AMARILLO", "VERDE"]
    assert apply(spark, [2, 3, 5, 7, 10, 11, None], gp.rhythm_band, "int") == [
        "90-100", "70-89", "50-69", "30-49", "10-29", "0-9", None,
    ]
    tier = lambda c: gp.confidence_tier(c, F.lit(10))
    assert apply(spark, [9, 8, 5, 4], tier, "int") == ["alta", "media", "media", "baja"]


def test_rule_classes_follow_priority(spark):
    values = [
        "Se llama al cliente por repuesto", "Pendiente repuesto", "PINTURA", "CORDIAL SALUDO, equipo", "sin novedad", "...",
    ]
    assert apply(spark, values, ct.classify) == [
        "comunicacion_cliente", "gestion_repuestos", "cambio_estado", "comunicacion_interna", "sin_cambio", "sin_clasificar",
    ]
