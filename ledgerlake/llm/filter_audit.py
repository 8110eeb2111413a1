"""Interaction of corpus filters: what each takes in every order of applying them.

Every document gets a mask, bit f set if it fails filter f.  Documents of one
part and mask fare alike whatever the order, so the corpus is counted by part and
mask first (at most 2^F counts a part); what follows works on those counts.

An order of filters is the inverse permutation: the step of each filter.  The step
that removes a mask is the min-plus product of its row of the mask matrix (0 where
it fails the filter, else infinite) with the order's column of the position matrix:
the least step among the filters that it fails.  One matrix of removal steps
(masks x orders) holds for all parts; counts scattered by it give what each step
removes, and the masks whose filter comes after their removal what is redundant.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Least words, least share of distinct words and largest share of capitals (per cent), signs.
LEAST_WORDS, DISTINCT_SHARE, CAPITAL_SHARE, SIGNS = 100, 80, 10, "#$%&*|"
FILTERS = "ABCDE"
#: Bit of the filter for copies, the only one that looks beyond its document.
COPY = 1 << FILTERS.index("E")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INSIDE = bytes(range(0x80, 0xC0))
_SIGN = re.compile(b"[" + re.escape(SIGNS.encode()) + b"]")


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # bytes split at 0x20 and 0x09 to 0x0D only
    points = len(text.translate(None, _INSIDE))  # UTF-8 without continuation bytes
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < DISTINCT_SHARE * len(words)) << 1
            | (100 * capitals > CAPITAL_SHARE * points) << 2
            | (_SIGN.search(text) is not None) << 3)


def _looked_at(texts: list) -> dict:
    texts = [t or b"" for t in texts]
    return {"digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            "mask": pa.array([own_mask(t) for t in texts], pa.int32())}


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Counts of documents by part and mask: part, mask, n, good, toxic.

    ``docs`` needs doc_id, text and the column ``part``; ``labels`` doc_id, quality and
    toxic.  A null text is an empty one, a null part the empty string.  A row fails
    E if a row of a smaller doc_id has the same text; a null doc_id is neither smaller
    nor larger than another.  Rows repeated count each.  A document is good (toxic) if
    any label of its id says so; without labels it is neither.
    """
    # one column carries id and part through the texts' function
    rows = docs.select(F.struct(F.col("doc_id").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")).alias("row"),
                       F.col("text").alias("text"))
    seen = map_texts(rows, "row", "text", "digest binary, mask int", _looked_at, as_bytes=True)
    seen = seen.groupBy(F.col("row.doc_id").alias("doc_id"), F.col("row.part").alias("part"), "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = seen.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    # joined on the digest and the id, so a text with many copies is no hot key
    flagged = (seen.join(first, ["digest", "doc_id"], "left")
               .select("doc_id", "part", "n", F.when(F.col("first") | F.col("doc_id").isNull(), F.col("mask"))
                       .otherwise(F.col("mask") + F.lit(COPY)).alias("mask")))
    label = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    return (flagged.join(label, "doc_id", "left").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))


def positions(filters: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders, and the inverse of each as a column: the step (from 1) of every filter."""
    orders = list(permutations(range(filters)))
    place = np.empty((filters, len(orders)), np.int64)
    for k, order in enumerate(orders):
        place[list(order), k] = np.arange(1, filters + 1)
    return orders, place


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product: the least sum of a row of ``a`` and a column of ``b``."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def removal_steps(filters: int) -> np.ndarray:
    """Step that removes each mask (row) in each order (column); ``filters + 1``: kept."""
    fails = (np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1
    return np.minimum(min_plus(np.where(fails == 1, 0, filters + 1), positions(filters)[1]), filters + 1)


class Audit:
    """Counts of every order and step from counts by mask."""

    def __init__(self, filters: int):
        orders, place = positions(filters)
        step = removal_steps(filters)
        mask = np.arange(1 << filters)
        self.filters, self.orders, self.place = filters, orders, place
        self.at = np.array(orders).T  # filter of each step (rows) in each order
        steps = np.arange(1, filters + 1)
        self.removes = step[:, :, None] == steps  # mask, order, step
        fails = ((mask[:, None, None] >> self.at.T[None]) & 1).astype(bool)
        self.redundant = fails & (step[:, :, None] < steps)
        self.alone = 1 << np.arange(filters)

    def scatter(self, where: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums of weights (part, mask) over the masks of ``where`` (mask, order, step)."""
        flat = where.reshape(len(where), -1).astype(np.int64)
        return (weights @ flat).reshape(len(weights), *where.shape[1:])

    def __call__(self, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
        """Each result is (part, order, step); the arguments are (part, mask)."""
        removed = self.scatter(self.removes, n)
        per_filter = np.take_along_axis(removed, (self.place.T - 1)[None], axis=2).sum(axis=1)  # part, filter
        return {"kept": n.sum(axis=1)[:, None, None] - removed.cumsum(axis=2), "removed": removed,
                "redundant": self.scatter(self.redundant, n), "unique_fails": n[:, self.alone][:, self.at.T],
                "good_lost": self.scatter(self.removes, good), "toxic_lost": self.scatter(self.removes, toxic),
                "shapley": per_filter[:, self.at.T]}


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Effects of all orders, from the counts of :func:`masks`: one row per part, order
    and step; ``shapley`` is the filter's removals summed over all orders.  Without
    rows there is no part, hence no row."""
    size = 1 << len(filters)
    # at most 2^F entries a part
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches):
        audit = Audit(len(filters))
        orders = ["".join(filters[f] for f in order) for order in audit.orders]
        rows = len(orders) * len(filters)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                parts = batch.column(0).slice(start, 256)
                weights = np.zeros((3, len(parts), size), np.int64)
                for p, entries in enumerate(batch.column(1).slice(start, 256).to_pylist()):
                    for e in entries:
                        weights[:, p, e["mask"]] = e["n"], e["good"], e["toxic"]
                found = audit(*weights)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(parts.to_pylist(), object), rows), pa.string()),
                     pa.array(np.tile(np.repeat(np.array(orders, object), len(filters)), len(parts)), pa.string()),
                     pa.array(np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(parts) * len(orders))),
                     *(pa.array(found[k].reshape(-1)) for k in names)], names=["part", "filter_order", "step", *names])

    return per_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{k} long" for k in names))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """All orders of the five filters over ``docs``, per value of ``part``."""
    return interactions(masks(docs, labels, part))
