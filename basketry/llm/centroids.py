"""Centroid clustering of whole-number vectors with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it. By the triangle
inequality the difference of two pivot distances is a lower bound of a distance, so in each round the bounds of a
vector and the centroids' own pivot distances rule out most centroids; those left get exact integer distances.
Rounds move the centroids to the exact floor of their members' mean. Only sums per cluster leave the tasks.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from basketry.llm.common import arrow_schema, renamed, stage

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
PIVOTS = 8
ROWS_AT_ONCE = 512
# Components up to this size keep a squared distance within 64 bits.
LARGEST = 1 << 27
_SLACK = 1e-6


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    d = x - y
    return (d * d).sum(-1)


def choose_pivots(candidates: np.ndarray, number: int) -> np.ndarray:
    """Rows far from each other: each next one has the largest sum of distances to those before."""
    chosen, total = [0], np.sqrt(squared(candidates, candidates[0]).astype(float))
    while len(chosen) < min(number, len(candidates)):
        rest = total.copy()
        rest[chosen] = -1
        chosen.append(int(rest.argmax()))
        total += np.sqrt(squared(candidates, candidates[chosen[-1]]).astype(float))
    return candidates[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(x, p).astype(float)) for p in pivots], 1)


def nearest(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, centroid_table: np.ndarray):
    """(cluster, squared distance, number of exact distances) of each row; of equal distances the smaller number."""
    bound = np.zeros((len(x), len(centroids)))
    for j in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, j, None] - centroid_table[None, :, j]), out=bound)
    bound = np.maximum(0, bound * (1 - 1e-12) - _SLACK) ** 2
    first = bound.argmin(1)
    least = squared(x, centroids[first])
    row, k = np.nonzero(bound <= least[:, None])
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[row, k] = squared(x[row], centroids[k])
    cluster = exact.argmin(1)
    return cluster, exact[np.arange(len(x)), cluster], len(row)


def _rows_of(batch, columns):
    """The array columns of a batch as matrices, a few rows at a time, with the rows' place."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        yield part, [np.asarray(part.column(c).flatten()).reshape(part.num_rows, -1) for c in columns]


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, v): vectors with the wanted number of finite components as whole numbers."""
    source = renamed(table, id=id_col, vec=vector_col)
    kept = source.where(F.size("vec") == dimensions).where(
        F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))))
    whole = kept.select("id", F.transform("vec", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))
    large = F.exists("v", lambda x: F.abs(x) > LARGEST)
    return whole.select("id", F.when(large, F.raise_error(F.lit(f"a component is beyond {LARGEST // scale}"))).otherwise(F.col("v")).alias("v"))


def cluster_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, seed: int = 2, pivots: int = PIVOTS, dimensions: int = DIMENSIONS,
                    scale: int = SCALE) -> DataFrame:
    """(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each usable vector.

    Rows whose vector is null, of another length, or with a null or non-finite component are left out. The first
    centroids are the rows with the smallest SHA-256 of ``seed:id`` (a null id reads ``null``; rows with one id go by
    their components), as many as there are. Ties go to the smaller number; a cluster without members keeps its
    centroid. Repeated rows and ids are vectors of their own. An empty table gives no rows. A component beyond
    2^27 / scale stops the job with an error, as its distances don't fit 64 bits. Other columns are not read.
    """
    vectors = stage(whole_vectors(table, id_col, vector_col, dimensions, scale), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    first = vectors.orderBy(order, "v").limit(clusters).select("v").collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dimensions)
    fixed = choose_pivots(centroids, pivots) if len(first) else centroids
    spark, id_type = table.sparkSession, vectors.schema["id"].dataType
    measured = StructType([StructField("id", id_type), StructField("v", ArrayType(LongType())), StructField("pivots", ArrayType(DoubleType()))])

    def measure(batches):
        for batch in batches:
            for part, (x,) in _rows_of(batch, [1]):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(pivot_distances(x, fixed)), pa.list_(pa.float64()))], schema=arrow_schema(measured))

    rows = stage(vectors.mapInArrow(measure, measured), "pivot-table")
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(rows, centroids, fixed)
    final, table_of = centroids, pivot_distances(centroids, fixed) if len(first) else None
    placed = StructType([StructField("id", id_type), StructField("cluster", IntegerType()), StructField("distance", LongType())])

    def assign(batches):
        for batch in batches:
            for part, (x, table) in _rows_of(batch, [1, 2]):
                cluster, distance, _ = nearest(x, table, final, table_of)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], schema=arrow_schema(placed))

    assigned = stage(rows.mapInArrow(assign, placed), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(final.tolist())]
    facts = sums.crossJoin(F.broadcast(total)).join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster")
    # One row for each cluster.
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(rows: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: each task sends the sums of its clusters' components and their members."""
    table_of, (k, dimensions) = pivot_distances(centroids, pivots), centroids.shape
    schema = StructType([StructField("cell", IntegerType()), StructField("value", LongType())])

    def add(batches):
        sums = np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            for _, (x, table) in _rows_of(batch, [1, 2]):
                cluster, _, _ = nearest(x, table, centroids, table_of)
                np.add.at(sums[:, :-1], cluster, x)
                sums[:, -1] += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums.ravel()[used])], schema=arrow_schema(schema))

    found = rows.select("id", "v", "pivots").mapInArrow(add, schema).groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    cells = {r["cell"]: int(r["value"]) for r in found.collect()}  # at most clusters x (dimensions + 1)
    moved = centroids.copy()
    for c in range(k):
        if n := cells.get(c * (dimensions + 1) + dimensions):
            moved[c] = [cells.get(c * (dimensions + 1) + j, 0) // n for j in range(dimensions)]
    return moved
