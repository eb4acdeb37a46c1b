"""Order inside a case: phase sequence, stalled phases and dates that run backwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import lexicon as lx
from caselog.functions import text as tx
from caselog.operators import skew


def phase_number(text: Column, phases: dict[str, list[str]] = lx.PHASES) -> Column:
    """Position of the first phase named in the text, null when none is."""

    def first_hit(folded: Column) -> Column:
        numbered = enumerate(phases.values(), start=1)
        return F.coalesce(*[F.when(tx.has_any(folded, words), F.lit(n)) for n, words in numbered])

    return tx.let(tx.fold(text), first_hit)


def phase_sequence(
    notes: DataFrame, keys: list[str], order: list[str], phase: str, budget: int = skew.TASK_ROWS
) -> DataFrame:
    """Tagged notes, phase changes and steps back to an earlier phase, per case."""
    tagged = notes.where(F.col(phase).isNotNull()).select(*keys, *order, phase)
    steps = skew.previous_in_key(tagged, keys, order, [phase], budget)
    before = F.col(f"prev.{phase}")
    return steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("notas_con_fase"),
        F.count_if(before != F.col(phase)).alias("cambios_fase"),
        F.count_if(before > F.col(phase)).alias("retrocesos_fase"),
    )


def backward_dates(
    notes: DataFrame, keys: list[str], arrival: str, day: str, budget: int = skew.TASK_ROWS
) -> DataFrame:
    """Notes dated before the note that arrived just ahead of them, per case."""
    slim = notes.where(F.col(day).isNotNull()).select(*keys, arrival, day)
    steps = skew.previous_in_key(slim, keys, [arrival], [day], budget)
    return steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("notas_con_fecha"),
        F.count_if(F.col(day) < F.col(f"prev.{day}")).alias("retrocesos"),
    )


def stalled_phases(
    notes: DataFrame,
    keys: list[str],
    order: list[str],
    phase: str,
    day: str,
    limit: int = 7,
    budget: int = skew.TASK_ROWS,
) -> DataFrame:
    """Longest time one phase was repeated without a change, and whether it exceeds the limit."""
    tagged = notes.where(F.col(phase).isNotNull()).select(*keys, *order, phase, F.col(day).alias("_day"))
    heavy = skew.heavy_keys(tagged, keys, budget)
    steps = skew.previous_in_key(tagged, keys, order, [phase, "_day"], heavy=heavy)
    changed = F.col("prev").isNull() | (F.col(f"prev.{phase}") != F.col(phase))
    starts = steps.where(changed).select(
        *keys, *order, F.col("_day").alias("_start"), F.col("prev._day").alias("_ended")
    )
    runs = skew.previous_in_key(starts, keys, order, ["_start"], heavy=heavy)
    closed = runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tramos"),
        F.max(F.datediff("_ended", "prev._start")).alias("_closed"),
        F.max_by("_start", F.struct(*order)).alias("_last_start"),
    )
    ends = tagged.groupBy(*keys).agg(F.max_by("_day", F.struct(*order)).alias("_last_day"))
    longest = F.greatest(
        F.coalesce("_closed", F.lit(0)), F.datediff("_last_day", "_last_start")
    )
    return closed.join(ends, keys).select(
        *keys,
        "tramos",
        longest.alias("dias_fase_mas_larga"),
        (longest > limit).alias("estancamiento_fase_detectado"),
    )
