"""Contact with the customer: coverage, gaps, alert levels and abandonment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselog.functions import lexicon as lx
from caselog.functions import text as tx
from caselog.operators.gaps import day_profile

# Days without contact that turn the light red; the other cut-offs are choices of this package.
RED_SILENCE, AMBER_SILENCE = 5, 3
CRITICAL_SILENCE, HIGH_SILENCE, MEDIUM_SILENCE = 15, 7, 5
HIGH_SHARE, MEDIUM_SHARE = 20.0, 50.0


def is_contact(text: Column, phrases: list[str] = lx.CONTACT_PHRASES) -> Column:
    return tx.has_any(tx.fold(text), phrases)


def contact_metrics(notes: DataFrame, keys: list[str], day: str, contact: Column) -> DataFrame:
    """Counts, share, contact dates and the days between them, per case.

    `silencio_maximo_dias` also counts the days from the first note to the first contact and from the
    last contact to the last note; without any contact it is null.
    """
    profile = day_profile(notes, keys, day, contactos=F.count_if(contact))
    touched = F.when((F.col("contactos") > 0) & F.col("dia").isNotNull(), F.col("dia"))
    earlier = (
        Window.partitionBy(*keys).orderBy("dia").rowsBetween(Window.unboundedPreceding, -1)
    )
    steps = profile.withColumn("_day", touched).withColumn("_prev", F.max("_day").over(earlier))
    steps = steps.withColumn("_gap", F.datediff("_day", "_prev"))
    dated = F.when(F.col("_day").isNotNull(), F.struct("_day", "_gap"))
    case = steps.groupBy(*keys).agg(
        F.sum("notas").alias("total_observaciones"),
        F.sum("contactos").alias("observaciones_con_contacto_cliente"),
        F.array_sort(F.collect_list(dated)).alias("_list"),
        F.max("_gap").alias("brecha_maxima_sin_contacto_dias"),
        F.avg("_gap").alias("frecuencia_promedio_contacto_dias"),
        F.greatest(
            F.max("_gap"),
            F.datediff(F.min("_day"), F.min("dia")),
            F.datediff(F.max("dia"), F.max("_day")),
        ).alias("silencio_maximo_dias"),
    )
    share = F.col("observaciones_con_contacto_cliente") * F.lit(100.0) / F.col("total_observaciones")
    return case.select(
        *keys,
        "total_observaciones",
        "observaciones_con_contacto_cliente",
        share.alias("porcentaje_comunicacion_cliente"),
        F.transform("_list", lambda e: F.date_format(e["_day"], "yyyy-MM-dd")).alias(
            "fechas_contacto_documentado"
        ),
        F.filter(F.transform("_list", lambda e: e["_gap"]), lambda g: g.isNotNull()).alias(
            "dias_entre_contactos"
        ),
        "brecha_maxima_sin_contacto_dias",
        "frecuencia_promedio_contacto_dias",
        "silencio_maximo_dias",
    )


def contact_alerts(metrics: DataFrame) -> DataFrame:
    """Adds the contact light and the alert level, by the longest silence towards the customer."""
    none = F.col("observaciones_con_contacto_cliente") == 0
    gap = F.coalesce("silencio_maximo_dias", F.lit(0))
    share = F.col("porcentaje_comunicacion_cliente")
    light = (
        F.when(none | (gap > RED_SILENCE), "ROJO")
        .when(gap >= AMBER_SILENCE, "AMARILLO")
        .otherwise(F.lit("VERDE"))
    )
    level = (
        F.when(none | (gap > CRITICAL_SILENCE), "CRITICA")
        .when((share < HIGH_SHARE) | (gap > HIGH_SILENCE), "ALTA")
        .when((share < MEDIUM_SHARE) | (gap > MEDIUM_SILENCE), "MODERADA")
        .otherwise(F.lit("SIN_ALERTA"))
    )
    return metrics.withColumns(
        {
            "codigo_visual": light,
            "nivel_alerta": level,
            "requiere_accion_inmediata": level.isin("CRITICA", "ALTA"),
        }
    )


def abandonment(
    notes: DataFrame,
    keys: list[str],
    text: str,
    closed: list[str] = lx.CLOSED_WORDS,
    verbs: list[str] = lx.CONTACT_VERBS,
) -> DataFrame:
    """Closed or withdrawn cases without any contact verb."""
    folded = tx.fold(F.col(text))
    case = notes.groupBy(*keys).agg(
        F.bool_or(tx.has_any(folded, closed)).alias("cerrado"),
        F.bool_or(tx.has_any(folded, verbs)).alias("con_contacto"),
    )
    found = F.col("cerrado") & ~F.col("con_contacto")
    return case.withColumns(
        {
            "detectada": found,
            "nivel_riesgo": F.when(found, "CRITICO").otherwise(F.lit("BAJO")),
        }
    )
