"""What the notes of a case say: length, repeats, dates, classes, risk words and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import lexicon as lx
from caselog.functions import numbers as nb
from caselog.functions import text as tx
from caselog.schemas import LAST_CLASS

# Score bands by share of informative notes; above 80, from 60, 40 and 20 percent.
INFORMATIVE_BANDS = [(80.0000001, "90-100"), (60, "70-89"), (40, "50-69"), (20, "30-49"), (5, "10-29")]
INFORMATIVE_WORST = "0-9"
PARTS_CLASS, PARTS_CAP, BARE_LOW, BARE_HIGH = "gestion_repuestos", 60, 30, 49
NOTE_WEIGHTS = (40, 35, 25)
# Lower bounds of the note score scale.
NOTE_SCALE = [(90, "90-100"), (70, "70-89"), (50, "50-69"), (30, "30-49"), (10, "10-29")]
# The contract names these four levels without cut-offs; the defaults follow the note scale.
CASE_LEVELS = [(90, "Excelente"), (70, "Bueno"), (50, "Regular")]


def is_generic(text: Column, words: list[str] = lx.GENERIC_WORDS) -> Column:
    return tx.is_blank(text) | tx.has_any(tx.fold(text), words)


def has_date(text: Column) -> Column:
    return tx.matches(text, lx.EXPLICIT_DATE)


def has_term(text: Column) -> Column:
    return tx.matches(tx.fold(text), lx.ESTIMATED_TERM)


def word_profile(notes: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Note count, word count mean, spread, minimum and maximum per case."""
    words = notes.select(*keys, tx.word_count(F.col(text)).alias("_w"))
    return words.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("notas"),
        F.avg("_w").alias("palabras_promedio"),
        F.stddev_pop("_w").alias("palabras_desviacion"),
        F.min("_w").alias("palabras_min"),
        F.max("_w").alias("palabras_max"),
    )


def date_mentions(notes: DataFrame, keys: list[str], text: str) -> DataFrame:
    return notes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("notas"),
        F.count_if(has_date(F.col(text))).alias("con_fecha"),
        F.count_if(has_term(F.col(text))).alias("con_plazo"),
    )


def same_text_key(text: Column) -> Column:
    """Digest of the note without case, accents and spacing."""
    return F.md5(tx.squeeze_strip(tx.fold(F.coalesce(text, F.lit("")))))


def near_text_key(text: Column) -> Column:
    """Digest of the set of words, digits and punctuation left out."""
    letters = F.regexp_replace(tx.fold(F.coalesce(text, F.lit(""))), r"(?U)[^\p{L}]+", " ")
    words = F.filter(F.split(letters, " "), lambda w: w != "")
    return F.md5(F.array_join(F.array_sort(F.array_distinct(words)), " "))


def repeats(notes: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Exact repeats, and further notes that differ only in digits, punctuation or word order.

    Digests are counted, case by case; notes are never compared pairwise.
    """
    column = F.col(text)
    marked = notes.select(
        *keys, near_text_key(column).alias("_near"), same_text_key(column).alias("_same")
    )
    texts = marked.groupBy(*keys, "_near", "_same").agg(F.count(F.lit(1)).alias("_n"))
    groups = texts.groupBy(*keys, "_near").agg(
        F.sum("_n").alias("_notes"), F.count(F.lit(1)).alias("_texts")
    )
    return groups.groupBy(*keys).agg(
        F.sum("_notes").alias("notas"),
        F.sum("_texts").alias("textos_distintos"),
        F.sum(F.col("_notes") - F.col("_texts")).alias("repeticiones_exactas"),
        F.sum(F.col("_texts") - 1).alias("repeticiones_similares"),
    )


def informative_share(
    notes: DataFrame, keys: list[str], text: str, generic: list[str] = lx.GENERIC_WORDS
) -> DataFrame:
    """Share of notes that neither repeat an earlier text nor are generic, with its score band."""
    column = F.col(text)
    marked = notes.select(
        *keys, same_text_key(column).alias("_same"), is_generic(column, generic).alias("_generic")
    )
    texts = marked.groupBy(*keys, "_same").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_and("_generic").alias("_generic")
    )
    case = texts.groupBy(*keys).agg(
        F.sum("_n").alias("notas"), F.count_if(~F.col("_generic")).alias("informativas")
    )
    share = F.col("informativas") * F.lit(100.0) / F.col("notas")
    return case.withColumn("porcentaje_informativo", share).withColumn(
        "banda", nb.band(share, INFORMATIVE_BANDS, INFORMATIVE_WORST)
    )


def complaint_risk(
    notes: DataFrame,
    keys: list[str],
    text: str,
    words: list[str] = lx.COMPLAINT_WORDS,
    legal: list[str] = lx.LEGAL_WORDS,
    parts: list[str] = lx.PARTS_WORDS,
    moved: list[str] = lx.RESCHEDULE_WORDS,
) -> DataFrame:
    """Words found and risk factors per case. ALTO with a legal word, MEDIO with any other sign."""
    folded = tx.fold(F.col(text))
    found = [F.bool_or(tx.has_any(folded, [w])).alias(f"_w{i}") for i, w in enumerate(words)]
    case = notes.groupBy(*keys).agg(
        *found,
        F.bool_or(tx.has_any(folded, legal)).alias("riesgo_legal"),
        F.bool_or(tx.has_any(folded, parts)).alias("problemas_repuestos"),
        F.bool_or(tx.has_any(folded, moved)).alias("reprogramacion_fechas"),
    )
    hits = F.array_compact(F.array(*[F.when(F.col(f"_w{i}"), w) for i, w in enumerate(words)]))
    other = (F.size(hits) > 0) | F.col("problemas_repuestos") | F.col("reprogramacion_fechas")
    level = F.when(F.col("riesgo_legal"), "ALTO").when(other, "MEDIO").otherwise(F.lit("BAJO"))
    return case.select(
        *keys,
        "riesgo_legal",
        "problemas_repuestos",
        "reprogramacion_fechas",
        hits.alias("palabras_clave_halladas"),
        level.alias("nivel_riesgo_queja"),
    )


def classify(text: Column, rules: dict[str, list[str]] = lx.CLASS_RULES) -> Column:
    """First class, in order of priority, one of whose indicators occurs."""

    def first_hit(folded: Column) -> Column:
        hits = [F.when(tx.has_any(folded, phrases), F.lit(name)) for name, phrases in rules.items()]
        return F.coalesce(*hits, F.lit(LAST_CLASS))

    return tx.let(tx.fold(text), first_hit)


def parts_rule(label: Column, score: Column, text: Column) -> Column:
    """Score of a parts note: at most 60 without a date, 30 to 49 when it only says pending."""
    bare = tx.matches(tx.fold(tx.strip_blank(text)), lx.BARE_PARTS_NOTE)
    undated = F.least(score, F.lit(PARTS_CAP))
    capped = F.when(bare, F.greatest(F.least(score, F.lit(BARE_HIGH)), F.lit(BARE_LOW))).otherwise(undated)
    return F.when((label == PARTS_CLASS) & ~has_date(text), capped).otherwise(score)


def note_quality(informative: Column, practical: Column, context: Column) -> Column:
    return nb.weighted(list(zip((informative, practical, context), NOTE_WEIGHTS)))


def note_band(score: Column) -> Column:
    return nb.band(score, NOTE_SCALE, "0-9")


def case_level(score: Column, levels: list[tuple[float, str]] = CASE_LEVELS) -> Column:
    return nb.band(score, levels, "Deficiente")


def missing_elements(classified: DataFrame, by: list[str], elements: str = "elementos_faltantes") -> DataFrame:
    """How often each missing element is named, with its priority."""
    named = classified.select(*by, F.explode(elements).alias("elemento"))
    named = named.withColumn("elemento", tx.squeeze_strip(F.lower("elemento"))).where("elemento <> ''")
    counted = named.groupBy(*by, "elemento").agg(F.count(F.lit(1)).alias("veces"))
    folded = tx.fold(F.col("elemento"))
    priority = F.when(tx.has_any(folded, lx.MISSING_PRIORITY["alta"]), "alta").when(
        tx.has_any(folded, lx.MISSING_PRIORITY["media"]), "media"
    )
    return counted.withColumn("prioridad", priority.otherwise(F.lit("opcional")))
