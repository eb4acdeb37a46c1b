"""Mixing sources to target weights: Poisson replication by hash, then a global shuffle. Native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import extra_name, query, table

SEED = 17
#: Without given weights, a source's share is its size to this power: 1 keeps the shares, 0 evens them.
SMOOTHING = 0.5
#: Up to so many sources travel to every task with their rates; more are joined by salted keys.
LISTED_SOURCES = 10_000
SALTS = 64
#: Larger means are drawn as a sum of equal parts, which keeps each table of probabilities short.
LARGEST_MEAN = 500.0
UNIT_DIGITS = 13


def unit_hash(*parts: Column | str | int) -> Column:
    """A number in [0, 1) from the MD5 of the parts; null counts as empty."""
    pieces = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in pieces])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, UNIT_DIGITS), 16, 10)
    return digits.cast("double") / F.lit(float(16**UNIT_DIGITS))


def poisson_table(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... far into the tail, for a Poisson variable of this mean."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct((-mean).alias("log"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("table"))

    def step(so_far: Column, k: Column) -> Column:
        log = so_far["log"] + F.ln(mean) - F.ln(k.cast("double"))
        total = so_far["sum"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("sum"), F.concat(so_far["table"], F.array(total)).alias("table")
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda so_far: so_far["table"])


def repetition_rates(
    docs: DataFrame, source: str, size: str, weights: DataFrame | None, total: float | None, smoothing: float
) -> DataFrame:
    """source, rate, parts, probabilities: how often each document of a source should come, on average.

    A source of size n and share w of the target total T has rate w T / n. Sizes are summed per task
    before they are shuffled.
    """
    sizes = docs.groupBy(F.col(source).cast("string").alias("source")).agg(
        F.greatest(F.sum(F.coalesce(F.col(size), F.lit(0))).cast("double"), F.lit(1.0)).alias("n")
    )
    if weights is None:
        shares = sizes.withColumn("w", F.pow("n", F.lit(smoothing)))
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("w"))
        shares = sizes.join(given, sizes["source"].eqNullSafe(given["_s"]), "left").drop("_s")
        shares = shares.withColumn("w", F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(0.0)))
    sums = shares.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    goal, weight = float(sums["n"] or 0.0) if total is None else float(total), float(sums["w"] or 1.0)
    rated = shares.select("source", (F.col("w") / F.lit(weight) * F.lit(goal) / F.col("n")).alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.ceil(F.col("rate") / LARGEST_MEAN), F.lit(1)).cast("int"))
    part = F.col("rate") / F.col("parts")
    return rated.withColumn("probabilities", F.when(part > 0, poisson_table(part)).otherwise(F.array(F.lit(1.0))))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    total: float | None = None,
    doc: str = "doc_id",
    source: str = "source",
    size: str = "n_chars",
    smoothing: float = SMOOTHING,
    seed: int = SEED,
    copy: str = "copy",
) -> DataFrame:
    """The documents, each as often as its source's rate asks, in a random order over all partitions.

    `weights` holds (source, weight); a source it leaves out comes not at all. Without it, shares are
    sizes to the power `smoothing`. `total` is the size aimed at, by default that of the input. A
    document's count inverts the Poisson distribution of its source's rate at a number hashed from
    seed and id, so it does not depend on the order or partitioning of rows. Column `copy` numbers
    the copies from 1 and replaces a column of that name; all other columns stay.

    A null source is a source of its own, null sizes count as 0, and a source of size 0 as of size 1.
    Rows with a null or repeated id share their count. An empty table gives no rows. Only the copies
    themselves are shuffled, by a hash, so hot sources and repeated rows spread evenly.
    """
    spark = docs.sparkSession
    rates = repetition_rates(docs, source, size, weights, total, smoothing)
    few = rates.limit(LISTED_SOURCES + 1).collect()
    key, salt, rate = (extra_name(docs, n) for n in ("_source", "_salt", "_rate"))
    if len(few) <= LISTED_SOURCES:
        listed = spark.createDataFrame(few, rates.schema).select(F.col("source").alias(key), F.struct("*").alias(rate))
        joined = docs.join(F.broadcast(listed), F.col(source).cast("string").eqNullSafe(F.col(key)))
    else:
        spread = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = spread.select(
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias(key), F.col("salt").alias(salt), F.struct("*").alias(rate)
        )
        salted = docs.withColumns(
            {
                key: F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
                salt: F.pmod(F.xxhash64(doc, size), F.lit(SALTS)).cast("int"),
            }
        )
        joined = salted.join(spread, [key, salt])

    def drawn(so_far: Column, number: Column) -> Column:
        return so_far + F.size(F.filter(F.col(f"{rate}.probabilities"), lambda p: p < number))

    parts = F.sequence(F.lit(1), F.col(f"{rate}.parts"))
    numbers = F.transform(parts, lambda part: unit_hash(seed, F.col(doc), part))
    counted = joined.withColumn(rate, F.aggregate(numbers, F.lit(0), drawn)).where(F.col(rate) > 0)
    counted = counted.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(rate).cast("long"))))
    names = [c for c in docs.columns if c.lower() != copy.lower()]
    place = extra_name(docs, "_place")
    mixed = counted.select(*names, copy, F.xxhash64(F.lit(seed), doc, copy).alias(place))
    return mixed.repartition(place).sortWithinPartitions(place).drop(place)


_SQL = f"""
WITH sizes AS (
    SELECT source, greatest(sum(coalesce(n_chars, 0))::DOUBLE, 1) AS n FROM documents GROUP BY source),
rates AS (
    SELECT source, n, sqrt(n) / (SELECT sum(sqrt(n)) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS rate FROM sizes),
steps AS (
    SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates),
logs AS (
    SELECT source, k, -rate + sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate) - ln(k) END)
        OVER (PARTITION BY source ORDER BY k) AS log FROM steps),
tables AS (
    SELECT source, k, sum(exp(log)) OVER (PARTITION BY source ORDER BY k) AS p FROM logs),
units AS (
    SELECT *, ('0x' || substr(md5('{SEED}:' || doc_id || ':1'), 1, {UNIT_DIGITS}))::BIGINT
        / {16**UNIT_DIGITS}::DOUBLE AS u FROM documents),
counts AS (
    SELECT u.doc_id, count(*) AS n FROM units u JOIN tables t ON u.source IS NOT DISTINCT FROM t.source AND t.p < u.u
    GROUP BY u.doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(range(1, c.n + 1)) AS copy
FROM documents d JOIN counts c USING (doc_id)
"""


@query("op4_mixing", _SQL)
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents repeated so that sources have shares by the square root of their size."""
    return mix_sources(table(spark, folder, "documents"))
