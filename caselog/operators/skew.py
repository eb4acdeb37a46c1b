"""Keeping hot keys out of single tasks.

A case, workshop or text may hold a third of all rows. Steps that must see a key's rows in order, or
gather them, first ask which keys exceed a row budget. That question is a narrow, map-side combined
count. Usually no key does, and the plain one-shuffle plan is used. Otherwise the hot rows are cut
into ordered chunks by a range partitioning, whatever their key, and only per-chunk results meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselog.session import cut_lineage

HEAVY_LIST_MAX = 10_000
TASK_ROWS = 1_000_000
CHUNK_BITS = 13


@dataclass(frozen=True)
class Heavy:
    """Keys above the budget: none, a short list, or too many to list."""

    rows: DataFrame | None
    listed: bool

    @property
    def none(self) -> bool:
        return self.listed and self.rows is None


def heavy_keys(
    df: DataFrame, keys: list[str], budget: int = TASK_ROWS, weight: Column | None = None, most_weight: int = 0
) -> Heavy:
    """Keys with more rows than the budget, or more weight in all than `most_weight`.

    The driver sees at most HEAVY_LIST_MAX keys.
    """
    weights = F.lit(0) if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), weights.alias("_w"))
    over = counts.where((F.col("_n") > budget) | (F.col("_w") > most_weight)).select(*keys)
    found = over.limit(HEAVY_LIST_MAX + 1).collect()
    if not found:
        return Heavy(None, True)
    if len(found) > HEAVY_LIST_MAX:
        return Heavy(None, False)
    return Heavy(df.sparkSession.createDataFrame(found, over.schema), True)


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality over the key columns."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def split_heavy(df: DataFrame, keys: list[str], heavy: Heavy) -> tuple[DataFrame | None, DataFrame | None]:
    """(normal rows, hot rows). The listed keys number at most HEAVY_LIST_MAX, so they broadcast."""
    if heavy.none:
        return df, None
    if not heavy.listed:
        return None, df
    hot = F.broadcast(heavy.rows)
    condition = same_key(df, heavy.rows, keys)
    return df.join(hot, condition, "left_anti"), df.join(hot, condition, "left_semi")


def ordered_chunks(df: DataFrame, order: list[str], bits: int | None = None) -> DataFrame:
    """Global order without a global task: adds `_rank` (increasing) and its `_chunk`.

    `order` must be a total order. Chunks hold at most 2**bits rows and never span two
    partitions, because the partition number sits in the high bits of the rank.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranked = placed.withColumn("_rank", F.monotonically_increasing_id())
    return ranked.withColumn("_chunk", F.shiftright("_rank", CHUNK_BITS if bits is None else bits))


def ordinal(df: DataFrame, order: list[str], name: str = "ordinal") -> tuple[DataFrame, int]:
    """Dense 0-based position in a total order, and the row count.

    Rows are range-partitioned and checkpointed once; the driver sees one count per partition.
    """
    ranked = cut_lineage(ordered_chunks(df, order).drop("_chunk"))
    ranked = ranked.withColumn("_slot", F.shiftright("_rank", 33))
    counts = ranked.groupBy("_slot").agg(F.count(F.lit(1)).alias("n")).orderBy("_slot").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["_slot"], total))
        total += row["n"]
    table = df.sparkSession.createDataFrame(offsets, "_slot long, _offset long")
    position = F.col("_offset") + F.col("_rank").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranked.join(F.broadcast(table), "_slot").withColumn(name, position)
    return placed.drop("_slot", "_rank", "_offset"), total


def previous_in_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    budget: int = TASK_ROWS,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Adds `prev`, a struct of the columns in the preceding row of the same key.

    Normal keys use one window. Hot keys use a window per chunk, and the last row of each chunk is
    handed to the next one.
    """
    heavy = heavy or heavy_keys(df, keys, budget)
    normal, hot = split_heavy(df, keys, heavy)
    value = F.struct(*[F.col(c) for c in columns])
    result = None
    if normal is not None:
        window = Window.partitionBy(*keys).orderBy(*order)
        result = normal.withColumn("prev", F.lag(value).over(window))
    if hot is not None:
        ranked = cut_lineage(ordered_chunks(hot, keys + order))
        inside = Window.partitionBy(*keys, "_chunk").orderBy("_rank")
        local = ranked.withColumn("_local", F.lag(value).over(inside))
        tails = ranked.groupBy(*keys, "_chunk").agg(F.max_by(value, "_rank").alias("_tail"))
        along = Window.partitionBy(*keys).orderBy("_chunk")
        carried = tails.withColumn("_carry", F.lag("_tail").over(along)).drop("_tail")
        joined = local.alias("l").join(
            carried.alias("c"), same_key(local, carried, keys + ["_chunk"]), "left"
        )
        filled = joined.select(
            *[F.col(f"l.{c}") for c in df.columns],
            F.coalesce(F.col("l._local"), F.col("c._carry")).alias("prev"),
        )
        result = filled if result is None else result.unionByName(filled)
    return result


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    budget: int = TASK_ROWS,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Join rows to a table holding each key once, without sending a hot key to one task.

    Hot keys are at most HEAVY_LIST_MAX, so their single table rows are broadcast.
    """
    heavy = heavy or heavy_keys(rows, keys, budget)
    if heavy.rows is None:
        return rows.join(table, keys, how)
    few = table.join(F.broadcast(heavy.rows), same_key(table, heavy.rows, keys), "left_semi")
    normal, hot = split_heavy(rows, keys, heavy)
    return normal.join(table, keys, how).unionByName(hot.join(F.broadcast(few), keys, how))
