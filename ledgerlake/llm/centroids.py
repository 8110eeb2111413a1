"""Centroid clustering with exact arithmetic on packed bit planes.

A vector of 64 integers is stored as one ``uint64`` per bit plane: bit k of plane
i is bit i of component k, in two's complement, so the highest plane counts
negative.  The inner product of two vectors is a weighted sum of the numbers of
set bits in the AND of their planes; with the squared lengths it gives exact
squared distances.  Each round every task adds the components of its vectors per
cluster (one row per cluster and task), Spark adds those, and only the sums of
the k clusters reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from .common import ship, written

#: Components of a vector (bits of a plane), and the factor before rounding down.
WIDTH, SCALE = 64, 256
#: Squared distances of components below this many bits fit a long.
BITS = 27
#: Vectors handled at once.
BLOCK = 4_096


def planes_of(integers: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes (n, planes) of integers (n, 64), component k in bit k."""
    bits = (integers[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def integers_of(planes: np.ndarray) -> np.ndarray:
    """The integers (n, 64) of bit planes (n, planes)."""
    n, count = planes.shape
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(n, count, 8), axis=2, bitorder="little")
    return np.einsum("npk,p->nk", bits, plane_weights(count))


def plane_weights(planes: int) -> np.ndarray:
    """Value of a set bit of each plane."""
    weight = 1 << np.arange(planes, dtype=np.int64)
    weight[-1] *= -1
    return weight


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products (n, k) of packed vectors (n, planes) and (k, planes)."""
    wa, wb = plane_weights(a.shape[1]), plane_weights(b.shape[1])
    total = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        # counts of one plane stay below 2^6 x 2^28
        part = np.zeros(total.shape, np.int64)
        for j in range(b.shape[1]):
            part += wb[j] * np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64)
        total += wa[i] * part
    return total


def lengths(a: np.ndarray) -> np.ndarray:
    """Squared lengths of packed vectors."""
    w = plane_weights(a.shape[1])
    out = np.zeros(len(a), np.int64)
    for i in range(a.shape[1]):
        for j in range(a.shape[1]):
            out += w[i] * w[j] * np.bitwise_count(a[:, i] & a[:, j]).astype(np.int64)
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance to it."""
    distance = lengths(vectors)[:, None] - 2 * dot(vectors, centroids) + lengths(centroids)[None, :]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(vectors)), cluster]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Id and integers (``ints``) of the vectors that have 64 components, none null or non-finite."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.transform(F.col(vector_col), lambda c: c.cast("double")).alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))  # NaN is greater
    return (rows.where(F.col("x").isNotNull() & (F.size("x") == WIDTH) & finite)
            .select("vec_id", F.transform("x", lambda c: F.floor(F.lit(float(SCALE)) * c)).alias("ints")))


def packed(kept: DataFrame, planes: int) -> DataFrame:
    """``vec_id`` and bit planes as bytes."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ints = part.column(1).flatten().to_numpy().reshape(-1, WIDTH)
                flat = planes_of(ints, planes).tobytes()
                step = 8 * planes
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([flat[k:k + step] for k in range(0, len(flat), step)], pa.binary())],
                    names=["vec_id", "planes"])

    return kept.mapInArrow(run, StructType([kept.schema["vec_id"]]).add("planes", BinaryType()))


def _blocks(batches, planes: int):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column(0), np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint64).reshape(-1, planes)


def assigned(table: DataFrame, centroids: np.ndarray, planes: int) -> DataFrame:
    """Cluster and squared distance of every packed vector."""
    c = planes_of(centroids, planes)

    def run(batches):
        for ids, vectors in _blocks(batches, planes):
            cluster, distance = nearest(vectors, c)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, StructType([table.schema["vec_id"]]).add("cluster", IntegerType()).add("distance", LongType()))


def cluster_sums(table: DataFrame, centroids: np.ndarray, planes: int) -> dict[int, list[int]]:
    """Per non-empty cluster the sums of the 64 components, then the number of vectors."""
    c = planes_of(centroids, planes)

    def run(batches):
        total = np.zeros((len(c), WIDTH + 1), np.int64)
        for _, vectors in _blocks(batches, planes):
            cluster, _ = nearest(vectors, c)
            order = np.argsort(cluster, kind="stable")
            found, start = np.unique(cluster[order], return_index=True)
            total[found, :WIDTH] += np.add.reduceat(integers_of(vectors)[order], start, axis=0)
            total[:, WIDTH] += np.bincount(cluster, minlength=len(c))
        held = np.flatnonzero(total[:, WIDTH])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(held, WIDTH + 1).astype(np.int32)), pa.array(np.tile(np.arange(WIDTH + 1, dtype=np.int32), len(held))),
             pa.array(total[held].reshape(-1))], names=["cluster", "place", "total"])

    # 65 rows per centroid, whatever the number of vectors
    rows = (table.mapInArrow(run, "cluster int, place int, total long").groupBy("cluster", "place")
            .agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).orderBy("cluster", "place").collect())
    sums: dict[int, list[int]] = {}
    for r in rows:
        sums.setdefault(r.cluster, []).append(int(r.total))
    return sums


def cluster(vectors: DataFrame, k: int, rounds: int, seed: str, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Cluster the vectors of 64 finite components, each turned into floor(256 x).

    The first centroids are the ``k`` vectors with the smallest hex SHA-256 of ``<seed>:<id>``
    (equal ids: by their integers), fewer if there are fewer vectors.  Each of ``rounds``
    assigns every vector to the nearest centroid (ties: smaller number) and replaces
    non-empty centroids by the floor of their vectors' mean; then vectors are assigned
    once more.  Result: vec_id, cluster, distance (squared), cluster_inertia, inertia
    and centroid_sha256 (of the components, joined by commas).

    Vectors that are null, of another length or with null or non-finite components take no part;
    repeated rows count each; a null id is never a first centroid unless only such are
    left.  A component of 2^27 or more after scaling raises ``ValueError``, as a long could not
    hold the distances.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = integer_vectors(vectors, id_col, vector_col)
    least, most, n = kept.agg(F.min(F.array_min("ints")), F.max(F.array_max("ints")), F.count(F.lit(1))).first()
    if n and max(-least, most) >= 1 << BITS:
        raise ValueError(f"components of {BITS} or more bits after scaling by {SCALE}")
    # two's complement: a plane for the sign above the bits of the largest magnitude
    planes = 1 + max(int(least).bit_length() if least >= 0 else int(-least - 1).bit_length(),
                     int(most).bit_length() if most >= 0 else int(-most - 1).bit_length()) if n else 1
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "ints").limit(k).collect()
    table = written(packed(kept, planes))
    centroids = np.array([r.ints for r in first], np.int64).reshape(-1, WIDTH)
    for _ in range(rounds if len(first) else 0):
        for place, (*sums, n) in cluster_sums(table, centroids, planes).items():
            centroids[place] = [s // n for s in sums]
    out = written(assigned(table, centroids, planes)) if len(first) else assigned(table, np.zeros((1, WIDTH), np.int64), planes)
    inertia = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("i"))
    found = {r.cluster: int(r.i) for r in inertia.collect()} if len(first) else {}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # one row per centroid, at most k
    of = spark.createDataFrame([(c, i, sum(found.values()), names[c]) for c, i in sorted(found.items())],
                               "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
