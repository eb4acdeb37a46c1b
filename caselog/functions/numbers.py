"""Number reading and rounding with the semantics of the scoring contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselog.functions.text import let

NUMBER = r"(?i)^\s*[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(inf|infinity|nan)\s*$"


def to_double(text: Column) -> Column:
    """A number written as text; null for anything else, suffixes such as 1d included."""
    bare = F.when(text.contains('"'), F.regexp_replace(text, '^"|"$', "")).otherwise(text)
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null, which greatest and least alone would not grant."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def half_even(value: Column) -> Column:
    return F.bround(value, 0)


def score_of(number: Column) -> Column:
    """Half-even whole number in 0..100; null, infinite or NaN gives 0.

    The number is mentioned several times, so pass a column, not a costly expression.
    """
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    bounded = clamp(F.rint(clamp(number, -1.0, 101.0)), 0.0, 100.0).cast("int")
    return F.when(usable, bounded).otherwise(F.lit(0))


def score_0_100(text: Column) -> Column:
    """The same of a number written as text; unreadable text gives 0."""
    return let(to_double(text), score_of)


def weighted(parts: list[tuple[Column, int]]) -> Column:
    """Sum of score times whole percentage, rounded half-even without float ties."""
    total = parts[0][0].cast("long") * parts[0][1]
    for score, percent in parts[1:]:
        total = total + score.cast("long") * percent
    return F.bround(total.cast("decimal(20,2)") / F.lit(100), 0).cast("int")


def band(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first threshold the value reaches, thresholds from high to low."""
    result = None
    for threshold, label in steps:
        result = (F if result is None else result).when(value >= threshold, F.lit(label))
    return result.otherwise(F.lit(otherwise))
