"""Approximate nearest neighbours by inner product: cross-polytope hashing with multiprobe tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import query, table
from caselog.session import cut_lineage

TABLES, PROBES, ROUNDS, SEED = 12, 16, 3, 7
#: A bucket is searched in blocks of about so many vectors and queries.
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 2_048
#: Vectors of one length and norm range are searched whole up to so many, in blocks of EXACT_BLOCK.
EXACT, EXACT_BLOCK = 4_096, 512
#: Scores this close to the last place are compared exactly.
MARGIN = 1e-6


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        pairs = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        step *= 2
    return rows.reshape(len(rows), width) / np.sqrt(width)


class CrossPolytope:
    """Pseudo-rotations HD HD HD, one per table, and the signed axes nearest to a rotated vector.

    A vector x of length at most `longest` becomes the unit vector (x, sqrt(longest^2 - |x|^2)) /
    longest, and a query q becomes (q, 0) / |q|: their inner products keep the order of those of q and x.
    """

    def __init__(self, dimension: int, longest: float, tables: int, seed: int):
        self.dimension, self.longest = dimension, longest
        self.width = 1 << max(dimension, 1).bit_length()
        signs = np.random.default_rng(seed).integers(0, 2, (tables, ROUNDS, self.width))
        self.signs = 2.0 * signs - 1

    def placed(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        out = np.zeros((len(vectors), self.width))
        if stored:
            out[:, : self.dimension] = vectors / self.longest
            out[:, self.dimension] = np.sqrt(np.maximum(0, 1 - (out**2).sum(axis=1)))
        else:
            out[:, : self.dimension] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return out

    def axes(self, placed: np.ndarray, number: int, probes: int) -> np.ndarray:
        """The `probes` nearest signed axes in table `number`, nearest first; axis i's opposite is i + width."""
        for signs in self.signs[number]:
            placed = hadamard(placed * signs)
        both = np.concatenate([placed, -placed], axis=1)
        if probes == 1:
            return both.argmax(axis=1)[:, None]
        return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def best_of(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, score) of the k rows of largest inner product per query, its own row aside.

    A matrix product narrows each query's rows down to those within MARGIN of the k-th; these are
    scored again one by one in a fixed order of additions, so equal vectors have equal scores.
    """
    found = []
    for low in range(0, len(queries), 256):
        part, names = queries[low : low + 256], query_ids[low : low + 256]
        rough = part @ rows.T
        rough[names[:, None] == row_ids[None, :]] = -np.inf
        keep = rough > -np.inf
        if rough.shape[1] > k:
            last = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
            scale = np.abs(last) + np.linalg.norm(part, axis=1) * np.linalg.norm(rows, axis=1).max()
            keep &= rough >= (last - MARGIN * scale)[:, None]
        at, to = np.nonzero(keep)
        score = np.concatenate(
            [np.zeros(0)]
            + [(part[at[i : i + 65_536]] * rows[to[i : i + 65_536]]).sum(axis=1) for i in range(0, len(at), 65_536)]
        )
        order = np.lexsort((row_ids[to], -score, at))
        at, to, score = at[order], to[order], score[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < k
        found.append((names[at[top]], row_ids[to[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    name: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, by inner product.

    Vectors of each number of components are searched on their own, and dealt into ranges of norm: within
    one the longest is sqrt(2) times the shortest at most. In a range of more than EXACT vectors every
    vector is put in one bucket of each table, that of its nearest signed axis; a query looks into the
    buckets of its `probes` nearest axes of each table, in all such ranges. The other ranges, and all of
    them for a query that found fewer than k rows, are searched whole. Candidates are reranked by the
    exact inner product of the original vectors in double precision, ties to the smaller id, a query's
    own id aside. Buckets are searched in blocks: a bucket of many vectors or queries is dealt out over
    tasks as (block of vectors, block of queries), so none is capped and none is held whole.

    Vectors that are null, zero, or that hold null or non-finite components take no part, nor do rows
    without an id; of rows that repeat an id one with the largest score counts. Fewer than k candidates
    of a query's number of components give fewer rows, an empty table none. Other columns are left out.
    """
    spark = vectors.sparkSession
    plain = F.col(vector).cast("array<double>")

    def valid(df: DataFrame) -> DataFrame:
        chosen = df.select(F.col(name).cast("long").alias("id"), plain.alias("v"))
        fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return chosen.where(F.col("id").isNotNull() & fine & F.exists("v", lambda x: x != 0))

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    level = F.coalesce(F.floor(2 * F.log2("norm") + 0.5), F.lit(0)).cast("int")
    stored, asked = (
        valid(df).withColumn("norm", norm).select("id", "v", F.size("v").alias("size"), level.alias("level"), "norm")
        for df in (vectors, queries)
    )
    large = stored.groupBy("size", "level").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    groups, base = {}, 0
    for r in large.where(F.col("n") > EXACT).orderBy("size", "level").collect():
        if 0 < r["longest"] < float("inf"):
            groups[r["size"], r["level"]] = base, r["longest"]
            base += tables * 2 * CrossPolytope(r["size"], r["longest"], 0, seed).width

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*FOUND_ORDER)

    first = ranked(_search(stored, asked, k, groups, tables, probes, seed))
    if not groups:
        return first
    first = cut_lineage(first)
    counts = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    ids = asked.select("id").distinct()
    short = ids.join(counts, ids["id"] == counts["query_id"], "left")
    short = cut_lineage(short.where(F.coalesce("n", F.lit(0)) < k).select(F.col("id").alias("_short")))
    if short.isEmpty():
        return first
    again = asked.join(short, asked["id"] == short["_short"], "left_semi")
    whole = ranked(_search(stored, again, k, {}, tables, probes, seed))
    return first.join(short, first["query_id"] == short["_short"], "left_anti").unionByName(whole)


def _search(
    stored: DataFrame,
    asked: DataFrame,
    k: int,
    groups: dict[tuple[int, int], tuple[int, float]],
    tables: int,
    probes: int,
    seed: int,
) -> DataFrame:
    """query_id, vec_id, score of the candidates: those of the probed buckets and all in no group.

    `groups` are the (number of components, norm range) that are hashed, with their first bucket and
    longest norm. What is in no group is in one bucket per number of components, probed by every query.
    """
    spark = stored.sparkSession

    def placed(df: DataFrame, is_stored: bool, with_vector: bool) -> DataFrame:
        def buckets(matrix: np.ndarray, size: int, level: int) -> Iterator[np.ndarray]:
            """(rows, probes) arrays of buckets."""
            own = {g: x for g, x in groups.items() if g[0] == size and (not is_stored or g[1] == level)}
            if not is_stored or not own:
                yield np.full((len(matrix), 1), -1 - size)
            if own:
                index = CrossPolytope(size, next(iter(own.values()))[1], tables, seed)
                unit = index.placed(matrix, is_stored)
                for number in range(tables):
                    axes = index.axes(unit, number, 1 if is_stored else probes) + number * 2 * index.width
                    for first, _longest in own.values():
                        yield axes + first

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, levels = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                kinds = np.stack([sizes, levels if is_stored else np.zeros_like(levels)], axis=1)
                for size, level in np.unique(kinds, axis=0).tolist():
                    chosen = np.nonzero((kinds == (size, level)).all(axis=1))[0]
                    for at in range(0, len(chosen), 2_000):
                        part = batch.take(pa.array(chosen[at : at + 2_000]))
                        for found in buckets(_matrix(part.column(1), size), size, level):
                            own = part.take(pa.array(np.repeat(np.arange(len(found)), found.shape[1])))
                            columns = [pa.array(found.ravel().astype(np.int64)), own.column(0)]
                            columns += [own.column(1)] if with_vector else []
                            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "id", "v"][: len(columns)])

        plain = df.select("id", "v", "size", "level")
        return plain.mapInArrow(run, "bucket long, id long" + ", v array<double>" * with_vector)

    def blocks(df: DataFrame, is_stored: bool, size: int) -> dict[int, int]:
        """bucket -> number of blocks; there are at most tables * axes buckets a group."""
        counts = placed(df, is_stored, False).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        whole = min(EXACT_BLOCK, size) if is_stored else size
        return {r["bucket"]: -(-r["n"] // (size if r["bucket"] >= 0 else whole)) for r in counts.collect()}

    row_blocks, query_blocks = blocks(stored, True, BLOCK_ROWS), blocks(asked, False, BLOCK_QUERIES)
    both = [(b, n, query_blocks[b]) for b, n in row_blocks.items() if b in query_blocks]
    if not both:
        return spark.createDataFrame([], "query_id long, vec_id long, score double")
    plan = spark.createDataFrame(both, "bucket long, row_blocks long, query_blocks long")

    def dealt(df: DataFrame, is_stored: bool) -> DataFrame:
        own, other = ("row_blocks", "query_blocks") if is_stored else ("query_blocks", "row_blocks")
        known = placed(df, is_stored, True).join(F.broadcast(plan), "bucket")
        mine = F.pmod(F.xxhash64("id"), F.col(own)).alias(own[:-1])
        theirs = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[:-1])
        return known.select("bucket", mine, theirs, F.lit(is_stored).alias("stored"), "id", "v").select(
            "bucket", "row_block", "query_block", "stored", "id", "v"
        )

    def search(group: pa.Table) -> pa.Table:
        kind = group.column("stored").to_numpy(zero_copy_only=False).astype(bool)
        if kind.all() or not kind.any():
            return pa.table({n: pa.array([], t) for n, t in FOUND})
        ids, matrix = group.column("id").to_numpy(), _matrix(group.column("v"), len(group.column("v")[0]))
        found = best_of(matrix[~kind], ids[~kind], matrix[kind], ids[kind], k)
        return pa.table({n: pa.array(x) for (n, _t), x in zip(FOUND, found)})

    pairs = dealt(stored, True).unionByName(dealt(asked, False))
    found = pairs.groupBy("bucket", "row_block", "query_block").applyInArrow(
        search, "query_id long, vec_id long, score double"
    )
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


FOUND = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
FOUND_ORDER = ("query_id", "rank", "vec_id", "score")


@query("op8_nearest")
def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
