"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are projected onto a few Gaussian directions.  Squared distances after
the projection, over true ones, follow a chi-square distribution.  A kd-tree over
the projections of a block of vectors gives them in order of projected distance;
they are verified with the true measure until the chance that a vector not yet
seen is nearer than the k-th best falls below ``1 - confidence``.

Inner products become distances by one more component that gives every vector of
a block the same length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

#: Projected dimensions (even), and the stopping test's confidence.
DIMENSIONS, CONFIDENCE = 16, 0.93
#: Vectors in a block (one kd-tree), queries in a chunk, vectors in a leaf.
BLOCK, CHUNK, LEAF = 65_536, 1_024, 128
SEED = 20


def chi_square(x: float, dimensions: int = DIMENSIONS) -> float:
    """Distribution function for an even number of dimensions."""
    half, term, total = x / 2, 1.0, 1.0
    for k in range(1, dimensions // 2):
        term *= half / k
        total += term
    return 1 - math.exp(-half) * total


def stop_radius(confidence: float, dimensions: int = DIMENSIONS) -> float:
    """The quantile: beyond so many times the squared distance of the k-th best, a
    nearer vector would have been seen with probability ``confidence``."""
    low, high = 0.0, 8.0 * dimensions + 200
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dimensions) < confidence else (low, middle)
    return high


class KdTree:
    """Leaves of a kd-tree (median splits of the widest dimension) and their boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        edges, stack = [], [(0, len(points))]
        while stack:
            a, b = stack.pop()
            if b - a <= leaf:
                edges.append((a, b))
                continue
            part = points[self.order[a:b]]
            widest = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(part[:, widest], middle)]
            stack += [(a, a + middle), (a + middle, b)]
        edges.sort()
        self.start = np.array([a for a, _ in edges])
        self.end = np.array([b for _, b in edges])
        ordered = points[self.order]
        self.low = np.minimum.reduceat(ordered, self.start)
        self.high = np.maximum.reduceat(ordered, self.start)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """Squared distance from the query to each leaf's box."""
        outside = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        return (outside * outside).sum(axis=1)


class Block:
    """One block of distinct vectors with their ids (smallest first)."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], dimensions: int = DIMENSIONS, seed: int = SEED):
        squared = (vectors * vectors).sum(axis=1)
        self.longest = float(squared.max())
        added = np.sqrt(np.maximum(self.longest - squared, 0))[:, None]
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, dimensions))
        projected = np.concatenate([vectors, added], axis=1) @ self.directions
        self.tree = KdTree(projected)
        self.projected = projected[self.tree.order].astype(np.float32)
        self.vectors = vectors[self.tree.order]
        self.single = self.vectors.astype(np.float32)
        self.ids = [ids[k] for k in self.tree.order.tolist()]
        self.members = [np.arange(a, b) for a, b in zip(self.tree.start.tolist(), self.tree.end.tolist(), strict=True)]
        self.verified = 0

    def search(self, query: np.ndarray, own: int, k: int, radius: float) -> list[tuple[float, int]]:
        """(score, id) of the nearest found, best first, without ``own``.  Vectors
        whose squared projected distance is above ``radius`` times the squared
        distance of the k-th best are left: the stopping test."""
        at, single = query @ self.directions[:-1], query.astype(np.float32)
        near = at.astype(np.float32)
        bounds = self.tree.bounds(at)
        order = np.argsort(bounds, kind="stable")
        bounds = np.append(bounds[order], np.inf)
        base = float(query @ query) + self.longest
        rows, scores = np.empty(0, np.int64), np.empty(0, np.float32)
        # The query's own vector may be among the best, and single precision is rounded: some spare ones stay.
        keep, enough, done, step = 2 * k + 8, np.inf, 0, 4
        waiting, apart = np.empty(0, np.int64), np.empty(0)
        while done < len(order) and bounds[done] <= enough:
            new = np.concatenate([self.members[leaf] for leaf in order[done:done + step]])
            away = self.projected[new] - near
            waiting = np.concatenate([waiting, new])
            apart = np.concatenate([apart, np.einsum("ij,ij->i", away, away)])
            done, step = min(done + step, len(order)), min(2 * step, 32)
            while len(waiting):
                # next in the order of projected distance: those nearer than any leaf to come
                ready = np.flatnonzero(apart <= min(bounds[done], enough))
                if not len(ready):
                    break
                if len(ready) > 256:
                    ready = ready[np.argpartition(apart[ready], 255)[:256]] if enough == np.inf else ready
                rows = np.concatenate([rows, waiting[ready]])
                scores = np.concatenate([scores, self.single[waiting[ready]] @ single])
                self.verified += len(ready)
                left = np.ones(len(waiting), bool)
                left[ready] = False
                waiting, apart = waiting[left], apart[left]
                if len(rows) > keep:
                    best = np.argpartition(-scores, keep)[:keep]
                    rows, scores = rows[best], scores[best]
                if len(rows) > k:
                    kth = float(np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1])
                    enough = radius * max(base - 2 * kth, 1e-12)
        exact = (self.vectors[rows] * query).sum(axis=1)
        found = [(float(s), i) for s, r in zip(exact, rows.tolist(), strict=True) for i in self.ids[r] if i != own]
        return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) in doubles of rows with a finite vector that is not zero."""
    vector = F.col("vector")
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                    & F.exists(vector, lambda x: x != 0)))


def nearest(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            confidence: float = CONFIDENCE, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """For each row of ``queries`` the ``k`` rows of ``df`` found nearest by inner
    product, its own id left out: query_id, rank (from 1), the id, score.  Fewer
    candidates than ``k`` are all returned; ties go to the smaller id.

    Null or zero vectors, vectors with null or non-finite components and rows with
    a null id take no part.  Vectors are compared with those of their own length
    only.  Equal vectors are one entry of the index with their ids, of which the
    ``k + 1`` smallest can matter; repeated ids count once.  Other columns take no
    part; an empty table on either side gives an empty result.

    Blocks of vectors meet chunks of queries in cells of bounded size; every cell
    builds its kd-tree, and the cells' results are ranked at the end.
    """
    ship(df.sparkSession)
    rows = usable(df, id_col, vector_col).distinct()
    by_vector = Window.partitionBy("vector").orderBy("id")
    entries = (rows.withColumn("n", F.row_number().over(by_vector)).filter(F.col("n") <= k + 1)
               .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = usable(queries, id_col, vector_col).distinct()
    blocks = max(1, -(-entries.count() // block))
    chunks = max(1, -(-asked.count() // chunk))

    def dealt(part, key, own, others, size):
        return (part.withColumn("dim", F.size("vector")).withColumn(own, F.pmod(F.xxhash64(key), F.lit(size)).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    index = dealt(entries, F.col("ids")[0], "block", chunks, blocks).withColumnRenamed("other", "chunk")
    wanted = dealt(asked, F.col("id"), "chunk", blocks, chunks).withColumnRenamed("other", "block")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            matrix = [np.array(t["vector"].combine_chunks().flatten(), np.float64).reshape(t.num_rows, -1) for t in (left, right)]
            here = Block(matrix[0], left["ids"].to_pylist())
            radius = stop_radius(confidence)
            for own, query in zip(right["id"].to_pylist(), matrix[1], strict=True):
                found = here.search(query, own, k, radius)
                out[0] += [own] * len(found)
                out[1] += [i for _, i in found]
                out[2] += [s for s, _ in found]
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    found = (index.groupBy("dim", "block", "chunk").cogroup(wanted.groupBy("dim", "block", "chunk"))
             .applyInArrow(search, "query_id long, id long, score double"))
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
