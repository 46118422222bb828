"""Clustering around centroids in exact whole numbers, by an incremental matrix of distances.

Vectors are turned into whole numbers, ``floor(scale * x)``. For every vector the dot products
with all centroids are kept, exact, in a table in the shared folder. A squared distance is
``|v|^2 - 2 v.c + |c|^2``. When a centroid moves, its dot products change by the products with
the components that moved, and only those are worked out; then the least distance is found
anew. The first round moves the centroids from zero. A centroid becomes
the componentwise floor of its vectors' mean, worked out from sums that Spark adds up per task
first; only centroids, counts and sums (``clusters`` rows) come to the driver.

Kept are vectors with exactly ``size`` components, none null, NaN or infinite. A component over
``LARGEST`` after scaling raises an error, because distances would not fit a long. Rows stand
for themselves: repeated rows and null ids are clustered like any other (a null id hashes as an
empty string). With fewer vectors than ``clusters`` every one starts a centroid; an empty table
gives an empty result. Ties go to the smaller number. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, texts

SIZE, SCALE, CLUSTERS, ROUNDS = 64, 256, 40, 5
#: Largest scaled component: squared distances then stay below 2**60 at 64 components.
LARGEST = 1 << 26


def _usable(vector: Column, size: int) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) == size) & F.forall(vector, finite), F.lit(False))


def whole_numbers(df: DataFrame, vec_id: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` of the vectors that take part, as whole numbers."""
    rows = df.select(df[f"`{vec_id}`"].alias("vec_id"), df[f"`{vector}`"].cast("array<double>").alias("x"))
    scaled = F.transform("x", lambda x: F.floor(x * scale).cast("int"))
    fits = F.forall("x", lambda x: F.abs(x * scale) <= LARGEST)
    error = F.raise_error(F.lit(f"a component exceeds {LARGEST} after scaling by {scale}")).cast("array<int>")
    return rows.filter(_usable(F.col("x"), size)).select("vec_id", F.when(fits, scaled).otherwise(error).alias("v"))


def _first(vectors: DataFrame, clusters: int) -> np.ndarray:
    """The vectors whose ids have the least hashes, in that order."""
    name = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("name"), "v").orderBy("name", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def add_products(dots: np.ndarray, vectors: np.ndarray, moves: np.ndarray) -> None:
    """Brings dot products up to date with moved centroids, component by component that moved."""
    for k, move in enumerate(moves):
        parts = np.flatnonzero(move)
        if len(parts):
            dots[:, k] += vectors[:, parts] @ move[parts]


def _advance(state: DataFrame, moves: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """``state`` after the centroids moved: new dot products, nearest centroid and its distance."""
    fields = [f for f in state.schema.fields if f.name in ("vec_id", "v")]
    fields += [T.StructField("dots", T.ArrayType(T.LongType())), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    schema, known = T.StructType(fields), "dots" in state.columns
    squares, (clusters, size) = (centroids * centroids).sum(axis=1), centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("v"), size)
            dots = _matrix(batch.column("dots"), clusters).copy() if known else np.zeros((len(vectors), clusters), np.int64)
            add_products(dots, vectors, moves)
            distance = (vectors * vectors).sum(axis=1)[:, None] - 2 * dots + squares
            nearest = distance.argmin(axis=1)
            least = distance[np.arange(len(vectors)), nearest]
            columns = [batch.column("vec_id"), batch.column("v"), _lists(dots, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(nearest.astype(np.int32)), pa.array(least)], names=schema.names)

    return state.select("vec_id", "v", *["dots"] * known).mapInArrow(work, schema)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid's floored mean; one without vectors stays."""
    sums = [F.sum(F.col("v")[i].cast("long")) for i in range(centroids.shape[1])]
    found = state.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*sums).alias("sums")).collect()
    after = centroids.copy()
    for row in found:
        after[row.cluster] = [total // row.n for total in row.sums]
    return after


def clusters(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    size: int = SIZE,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, v, cluster, distance`` of every vector that takes part, and the centroids.

    ``rounds`` times vectors are assigned and centroids moved; then vectors are assigned once more.
    """
    state = whole_numbers(df, vec_id, vector, size, scale)
    centroids = _first(state, clusters)
    if not len(centroids):
        return state.limit(0).select("*", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, size), np.int64)
    moves, before = centroids, None
    for number in range(rounds + 1):
        state = shared.keep(_advance(state, moves, centroids))
        if before is not None:
            shared.drop(before)
        before = state
        if number < rounds:
            after = _means(state, centroids)
            moves, centroids = after - centroids, after
    return state.select("vec_id", "v", "cluster", "distance"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` with the sums of distances and a digest of the centroid."""
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    each = each.collect()  # a row for each cluster
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    total = sum(r.cluster_inertia for r in each)
    rows = [(r.cluster, r.cluster_inertia, total, digest(centroids[r.cluster])) for r in each]
    sums = found.sparkSession.createDataFrame(rows, schema)
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
