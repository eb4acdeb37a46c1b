"""Centroid clustering: rounds of assignment by the threshold algorithm, and of exact whole means."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import query, table
from caselog.session import cut_lineage

CLUSTERS, ROUNDS, COMPONENTS, SCALE, SALT = 16, 3, 64, 64, "1"
#: A block of vectors is compared in arrays of about so many numbers.
BLOCK_CELLS = 1 << 21
#: Partial sums of a cluster are folded in so many groups before they meet.
GROUPS = 32
FAR = np.iinfo(np.int64).max


class SortedCentroids:
    """Per dimension the centroids in order of their value there, to be walked outward from a vector's value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, np.int64)
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(self.centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid; ties go to the smaller number.

        Each round takes the next centroid of every list, works out the exact distances of those not
        met before, and adds up the squared gaps to the lists' frontiers. Centroids not yet met are at
        least that far, so a vector is done once this sum strictly exceeds its best distance.
        """
        clusters, dimensions = self.centroids.shape
        number = np.zeros(len(vectors), np.int64)
        best = np.full(len(vectors), FAR)
        met = np.zeros((len(vectors), clusters), bool)
        right = np.empty(vectors.shape, np.int64)
        for d in range(dimensions):
            right[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        left, left_out = right - 1, np.arange(len(vectors))
        lists = np.arange(dimensions)[None, :]
        for _round in range(clusters):
            if not len(left_out):
                break
            here = vectors[left_out]
            below = np.where(left >= 0, here - self.values[np.maximum(left, 0), lists], FAR)
            above = np.where(
                right < clusters, self.values[np.minimum(right, clusters - 1), lists] - here, FAR
            )
            down = below <= above
            seen = self.order[np.where(down, left, right), lists]
            left, right = left - down, right + ~down
            fresh = np.zeros((len(left_out), clusters), bool)
            fresh[np.arange(len(left_out))[:, None], seen] = True
            fresh &= ~met[left_out]
            met[left_out] |= fresh
            row, column = np.nonzero(fresh)
            exact = np.full(fresh.shape, FAR)
            exact[row, column] = ((here[row] - self.centroids[column]) ** 2).sum(axis=1)
            found = exact.argmin(axis=1)
            distance = exact[np.arange(len(found)), found]
            old = best[left_out]
            better = (distance < old) | ((distance == old) & (distance < FAR) & (found < number[left_out]))
            number[left_out[better]], best[left_out[better]] = found[better], distance[better]
            going = (np.minimum(below, above) ** 2).sum(axis=1) <= best[left_out]
            left, right, left_out = left[going], right[going], left_out[going]
        return number, best

    def blocks(self, vectors: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """nearest() over blocks of bounded size."""
        step = max(1, BLOCK_CELLS // max(1, self.centroids.size))
        for low in range(0, len(vectors), step):
            part = slice(low, low + step)
            yield part, *self.nearest(vectors[part])


def whole_vectors(column: pa.Array, components: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, whole components) of the vectors that take part, as floor(scale * x)."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == components)
    values = column.take(pa.array(at)).flatten()
    matrix = values.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(len(at), components)
    fine = np.isfinite(matrix).all(axis=1)
    whole, most = np.floor(scale * matrix[fine]), math.isqrt((1 << 61) // max(components, 1))
    if whole.size and np.abs(whole).max() >= most:
        raise ArithmeticError(f"a component times {scale} is {most} or more: squared distances may pass 64 bits")
    return at[fine], whole.astype(np.int64)


def _takes_part(vector: Column, components: int) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce((F.size(vector) == components) & F.forall(vector, finite), F.lit(False))


def first_centroids(vectors: DataFrame, clusters: int, components: int, scale: int, salt: str) -> np.ndarray:
    """The vectors of the smallest hashes, `clusters` rows at most; a null id counts as last."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    chosen = vectors.where(_takes_part(F.col("v"), components)).withColumn("digest", digest)
    rows = chosen.orderBy(F.col("digest").asc_nulls_last(), "v").limit(clusters).collect()
    found = whole_vectors(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), components, scale)[1]
    return found.reshape(len(rows), components)


def _partial_sums(centroids: np.ndarray, scale: int):
    """One row per cluster and task: how many vectors are nearest to it, and their sum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = SortedCentroids(centroids)
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            _at, whole = whole_vectors(batch.column(0), centroids.shape[1], scale)
            for part, number, _distance in index.blocks(whole):
                by_number = np.argsort(number, kind="stable")
                names, starts, n = np.unique(number[by_number], return_index=True, return_counts=True)
                counts[names] += n
                sums[names] += np.add.reduceat(whole[part][by_number], starts, axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """Every non-empty centroid becomes its vectors' componentwise floor(sum / count).

    The driver sees one row a cluster.
    """
    partial = vectors.select("v").mapInArrow(
        _partial_sums(centroids, scale), "cluster long, n long, sums array<long>"
    )
    exact = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(centroids.shape[1])]
    names = [f"s{i}" for i in range(centroids.shape[1])]
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")
    grouped = partial.select("cluster", "n", "sums", group).groupBy("cluster", "group")
    folded = grouped.agg(F.sum("n").alias("n"), *exact)
    total = folded.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
    result = centroids.copy()
    for row in total.collect():
        result[row["cluster"]] = [int(row[c]) // row["n"] for c in names]
    return result


def assigned(vectors: DataFrame, centroids: np.ndarray, scale: int, id_type: str) -> DataFrame:
    """(id, cluster, distance) of every vector that takes part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = SortedCentroids(centroids)
        for batch in batches:
            at, whole = whole_vectors(batch.column(1), centroids.shape[1], scale)
            for part, number, distance in index.blocks(whole):
                ids = batch.column(0).take(pa.array(at[part]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(number.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
                )

    return vectors.select("id", "v").mapInArrow(run, f"id {id_type}, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    id_column: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    salt: str = SALT,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors with exactly `components` components, none null or non-finite, take part; each component
    x counts as floor(scale * x). Centroids start as the vectors of the smallest sha256 of
    `salt:id`, move `rounds` times to their vectors' whole means, and every vector is assigned once
    more. With fewer vectors than clusters each vector starts one; without any there are no rows.
    Repeated rows count as often as they come and all return; a null id starts a cluster last. Ties
    go to the smaller centroid number. Scaled components so large that a squared distance may pass 64
    bits (about 1.9e8 for 64 components) raise ArithmeticError.

    A round reads the vectors once and shuffles one row per task and cluster. Tasks get the centroids
    (clusters * components numbers, whatever the input), and the driver one row a cluster.
    """
    named = vectors.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    id_type = named.schema["id"].dataType.simpleString()
    centroids = first_centroids(named, clusters, components, scale, salt)
    if len(centroids):
        for _round in range(rounds):
            centroids = moved(named, centroids, scale)
        found = cut_lineage(assigned(named, centroids, scale, id_type))
    else:
        found = named.sparkSession.createDataFrame([], f"id {id_type}, cluster int, distance long")
    inertia = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(c, d, sum(inertia.values()), digests[c]) for c, d in inertia.items()]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    known = found.join(F.broadcast(found.sparkSession.createDataFrame(facts, names)), "cluster")
    facts_of = ("distance", "cluster_inertia", "inertia", "centroid_sha256")
    return known.select(F.col("id").alias(id_column), "cluster", *facts_of)


def _sql() -> str:
    whole = f"list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT)"
    fine = f"len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {COMPONENTS}"
    steps = [
        f"""v AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, {whole} AS w FROM embeddings WHERE {fine}),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY h) - 1 AS c, w AS m
        FROM (SELECT sha256('{SALT}:' || vec_id) AS h, w FROM v ORDER BY h LIMIT {CLUSTERS}))"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
        SELECT r, min((d, c)) AS best FROM (
            SELECT r, c, list_sum(list_transform(list_zip(w, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM v, c{i}) GROUP BY r)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""s{i} AS (
        SELECT c, i, sum(x) AS s, count(*) AS n FROM (
            SELECT best[2] AS c, unnest(w) AS x, unnest(range({COMPONENTS})) AS i FROM a{i} JOIN v USING (r))
        GROUP BY c, i),
    c{i + 1} AS MATERIALIZED (
        SELECT c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
            SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{i} GROUP BY c) n USING (c))"""
            )
    return f"""
    WITH {", ".join(steps)},
    f AS (SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance FROM a{ROUNDS} JOIN v USING (r))
    SELECT vec_id, cluster, distance,
           (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
           (sum(distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM f JOIN c{ROUNDS} ON c = cluster"""


@query("op12_centroids", _sql())
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding's cluster."""
    return cluster_vectors(table(spark, folder, "embeddings"))
