"""Time between the notes of a case.

Notes are first counted per case and calendar day, combined on the map side. Every later step works
on that profile: a case has at most as many rows as its span has days, however many notes it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselog.functions import dates as dt
from caselog.functions import numbers as nb

RED_GAP, AMBER_GAP, LONG_GAP = 7, 4, 5

# Score bands of the update rhythm, by business days without news.
RHYTHM_BANDS = [(2, "90-100"), (3, "70-89"), (5, "50-69"), (7, "30-49"), (10, "10-29")]
RHYTHM_WORST = "0-9"


def day_profile(notes: DataFrame, keys: list[str], day: str, **measures: Column) -> DataFrame:
    """keys, dia, notas and further counts; undated notes keep a null day."""
    extra = [m.alias(name) for name, m in measures.items()]
    return notes.groupBy(*keys, F.col(day).cast("date").alias("dia")).agg(
        F.count(F.lit(1)).alias("notas"), *extra
    )


def day_gaps(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the preceding day, and calendar and business days since then."""
    window = Window.partitionBy(*keys).orderBy("dia")
    dated = profile.where(F.col("dia").isNotNull()).withColumn("dia_previo", F.lag("dia").over(window))
    return dated.withColumns(
        {
            "dias": F.datediff("dia", "dia_previo"),
            "habiles": dt.business_days(F.col("dia_previo"), F.col("dia")),
        }
    )


def _median(gaps: Column, zeros: Column) -> Column:
    """Median of `zeros` zeros followed by the sorted gaps."""
    count = F.size(gaps) + zeros
    at = lambda i: F.when(i < zeros, F.lit(0)).otherwise(F.get(gaps, (i - zeros).cast("int")))
    low, high = F.floor((count - 1) / F.lit(2)), F.ceil((count - 1) / F.lit(2))
    return F.when(count > 0, (at(low) + at(high)) / F.lit(2.0))


def gap_metrics(profile: DataFrame, keys: list[str], long_gap: int = LONG_GAP) -> DataFrame:
    """Span, rhythm and gap statistics per case. Notes of one day count as gaps of zero."""
    gaps = day_gaps(profile, keys)
    case = gaps.groupBy(*keys).agg(
        F.sum("notas").alias("notas"),
        F.min("dia").alias("primera"),
        F.max("dia").alias("ultima"),
        F.max("dias").alias("_max"),
        F.min("dias").alias("_min"),
        F.sum(F.col("notas") - 1).alias("_zeros"),
        F.count_if(F.col("dias") > long_gap).alias("brechas_largas"),
        F.max("habiles").alias("_max_habil"),
        F.sum("habiles").alias("_sum_habil"),
        F.sort_array(F.collect_list("dias")).alias("_gaps"),
    )
    several = F.col("notas") > 1
    steps = F.col("notas") - 1
    span = F.datediff("ultima", "primera")
    return case.select(
        *keys,
        "notas",
        "primera",
        "ultima",
        span.alias("dias_duracion"),
        (F.col("notas") / F.greatest(span / F.lit(7.0), F.lit(1.0))).alias("notas_por_semana"),
        F.when(several, F.coalesce("_max", F.lit(0))).alias("brecha_maxima"),
        F.when(several, F.when(F.col("_zeros") > 0, 0).otherwise(F.col("_min"))).alias("brecha_minima"),
        F.when(several, span / steps).alias("brecha_promedio"),
        _median(F.col("_gaps"), F.col("_zeros")).alias("brecha_mediana"),
        "brechas_largas",
        F.when(several, F.coalesce("_max_habil", F.lit(0))).alias("brecha_maxima_habil"),
        F.when(several, F.coalesce("_sum_habil", F.lit(0)) / steps).alias("brecha_promedio_habil"),
        F.coalesce("_sum_habil", F.lit(0)).alias("dias_habiles"),
    )


def time_light(max_gap: Column, red: int = RED_GAP, amber: int = AMBER_GAP) -> Column:
    return (
        F.when(max_gap > red, "ROJO").when(max_gap >= amber, "AMARILLO").otherwise(F.lit("VERDE"))
    )


def rhythm_band(max_business_gap: Column) -> Column:
    result = None
    for limit, label in RHYTHM_BANDS:
        result = (F if result is None else result).when(max_business_gap <= limit, F.lit(label))
    return F.when(max_business_gap.isNotNull(), result.otherwise(F.lit(RHYTHM_WORST)))


def confidence_tier(usable: Column, total: Column) -> Column:
    """Share of notes with date and text: alta above 80 %, media from 50 %, else baja."""
    share = usable * F.lit(100) / F.nullif(total, F.lit(0))
    return nb.band(F.coalesce(share, F.lit(0.0)), [(80.0000001, "alta"), (50, "media")], "baja")
