"""Quality classifier: random-indexing word vectors pooled per document, then a
two-layer network in numpy whose probabilities are calibrated by a temperature.

Every word (hashed to one of ``BUCKETS``) has a fixed sparse vector of signs.  Its
word vector is the sum of its neighbours' sparse vectors over all documents: a
count that tasks take for themselves and Spark adds up.  A document's input to
the network is the mean and the spread of its word vectors, the mean product of
adjacent ones, and a few shares of characters, words and lines.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, ship, text_batches, with_texts, written

BUCKETS, DIMENSIONS, SIGNS, REACH = 1 << 14, 32, 2, 2
#: Labelled rows that the network is fitted on at most (the first by a hash of their id).
SAMPLE = 20_000
#: Buckets whose sums travel in one row; tasks whose sums are added in a first step.
ROWS, FAN_IN = 64, 64
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 60, 128, 3e-3, 1e-4, 7
#: Every so many-th fitted row is kept for the temperature.
CALIBRATION = 6
THRESHOLD = 0.3

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")
#: Kinds of bytes: upper case, lower case, digit, white space, other ASCII, beyond ASCII.
_KIND = np.array([0 if 65 <= c <= 90 else 1 if 97 <= c <= 122 else 2 if 48 <= c <= 57 else 3 if c in b" \t\n\r\v\f"
                  else 4 if c < 128 else 5 for c in range(256)], np.uint8)
KINDS = 6


class _Buckets(dict):
    def __missing__(self, word):
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = zlib.crc32(word) & (BUCKETS - 1)
        return value


_BUCKETS = _Buckets()


def tokens(text: bytes | None) -> np.ndarray:
    """Buckets of the words and runs of signs of a text."""
    found = _TOKEN.findall(text) if text else []
    return np.fromiter(map(_BUCKETS.__getitem__, found), np.int64, len(found))


def sparse_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every bucket's sparse vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMENSIONS, (BUCKETS, SIGNS)), rng.choice(np.array([-1, 1]), (BUCKETS, SIGNS))


def add_contexts(sums: np.ndarray, texts: list[bytes | None], places: np.ndarray, signs: np.ndarray) -> None:
    """Add the neighbours' sparse vectors of each word of the texts to ``sums``."""
    each = [tokens(t) for t in texts]
    words = np.concatenate(each) if each else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(each)), [len(e) for e in each])
    flat = sums.reshape(-1)
    for reach in range(1, REACH + 1):
        same = row[reach:] == row[:-reach]
        left, right = words[:-reach][same], words[reach:][same]
        for a, b in ((left, right), (right, left)):
            for k in range(SIGNS):
                np.add.at(flat, a * DIMENSIONS + places[b, k], signs[b, k])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, from every text of ``docs`` (id, text)."""
    ship(docs.sparkSession)

    def count(batches):
        places, signs = sparse_vectors()
        sums = np.zeros((BUCKETS, DIMENSIONS), np.int64)
        for part in text_batches(batches):
            add_contexts(sums, part.column(1).to_pylist(), places, signs)
        rows = sums.reshape(-1, ROWS * DIMENSIONS)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * (ROWS * DIMENSIONS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)),
                                          pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))], names=["block", "sums"])

    def add(group: pa.Table) -> pa.Table:
        values = group["sums"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"block": group["block"].slice(0, 1), "sums": pa.array([values], pa.list_(pa.int64()))})

    partial = (docs.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(count, "block int, sums array<long>")
               .withColumn("salt", F.expr(f"spark_partition_id() div {FAN_IN}")))
    total = (partial.groupBy("block", "salt").applyInArrow(add, "block int, sums array<long>")
             .groupBy("block").applyInArrow(add, "block int, sums array<long>"))
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    for row in total.collect():  # as many rows as there are blocks, whatever the input
        vectors[row.block * ROWS:(row.block + 1) * ROWS] = np.array(row.sums).reshape(ROWS, DIMENSIONS)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return (vectors / np.maximum(length, 1)).astype(np.float32)


FEATURES = 3 * DIMENSIONS + KINDS + 6


def features(text: bytes | None, vectors: np.ndarray) -> np.ndarray:
    """Input of the network; all zero for a null or empty text."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    out[-KINDS:] = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=KINDS) / len(text)
    words = tokens(text)
    if len(words):
        pooled = vectors[words]
        mean = pooled.mean(axis=0)
        out[:DIMENSIONS] = mean
        out[DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(np.einsum("ij,ij->j", pooled, pooled) / len(words) - mean * mean, 0))
        if len(words) > 1:
            out[2 * DIMENSIONS:3 * DIMENSIONS] = np.einsum("ij,ij->j", pooled[1:], pooled[:-1]) / (len(words) - 1)
        lines = [x for x in text.split(b"\n") if x]
        out[3 * DIMENSIONS:3 * DIMENSIONS + 6] = (
            np.log1p(len(words)), len(np.unique(words)) / len(words), float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0,
            len(set(lines)) / max(1, len(lines)), len(text) / len(words) / 10, np.log1p(len(lines)))
    return out


@dataclass
class Network:
    """Two layers on standardised input, and a temperature; without layers, a constant."""

    layers: tuple[np.ndarray, ...] | None
    centre: np.ndarray | None
    scale: np.ndarray | None
    temperature: float
    constant: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit by Adam, then the temperature by search on rows kept apart.  With
    labels of one kind only, or none, the score is their mean, or 0.5."""
    if len(np.unique(y)) < 2:
        return Network(None, None, None, 1.0, float(y.mean()) if len(y) else 0.5)
    apart = np.arange(len(y)) % CALIBRATION == 0
    apart &= len(y) >= 10 * CALIBRATION
    train_x, train_y = x[~apart].astype(np.float64), y[~apart].astype(np.float64)
    if len(np.unique(train_y)) < 2:
        apart[:] = False
        train_x, train_y = x.astype(np.float64), y.astype(np.float64)
    rng = np.random.default_rng(SEED)
    net = Network(None, train_x.mean(axis=0), train_x.std(axis=0) + 1e-3, 1.0, 0.0)
    width = x.shape[1]
    params = [rng.standard_normal((width, HIDDEN)) / np.sqrt(width), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    inputs, step = (train_x - net.centre) / net.scale, 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(len(inputs)), max(1, len(inputs) // BATCH)):
            a, target = inputs[rows], train_y[rows]
            hidden = np.tanh(a @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -50, 50))) - target) / len(rows)
            back = error[:, None] * params[2] * (1 - hidden * hidden)
            gradients = [a.T @ back + DECAY * params[0], back.sum(axis=0), hidden.T @ error + DECAY * params[2], error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(gradients):
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] = params[k] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.layers = tuple(params)
    if apart.any():
        logits, target = net.logits(x[apart]), y[apart]
        low, high = np.log(0.5), np.log(20.0)
        for _ in range(60):  # the loss has one valley in the temperature
            a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
            low, high = (low, b) if _loss(logits / np.exp(a), target) < _loss(logits / np.exp(b), target) else (a, high)
        net.temperature = float(np.exp((low + high) / 2))
    return net


def held_out(id_col: str):
    """Rows that labels are never learnt from: crc32 of the id's text divisible by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", label_col: str = "quality",
          sample: int = SAMPLE) -> Network:
    """The network, fitted on at most ``sample`` labelled rows of ``docs`` (id, text).
    Null labels are left out; of several labels of an id the greater number decides, 1 of equal ones."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("target"))
             .orderBy(F.xxhash64("id"), "id").limit(sample))
    known = F.broadcast(written(known))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(texts):
        rows = np.array([features(t, shared.value) for t in texts], np.float32).reshape(len(texts), FEATURES)
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * FEATURES
        return {"x": pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))}

    chosen = docs.join(known.select("id"), "id", "left_semi")
    rows = (map_texts(chosen, "id", "text", "x array<float>", pool, as_bytes=True).join(known, "id")
            .orderBy(F.xxhash64("id"), "id").limit(sample).collect())
    x = np.array([r.x for r in rows], np.float32).reshape(len(rows), FEATURES)
    return fit(x, np.array([r.target for r in rows], np.float64))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
             label_col: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``df``: id, held_out, score (0 to 1, higher: label 1 likelier),
    predicted (1 if the score reaches ``threshold``).

    Only the text goes into a score.  Null and empty texts are scored as an input
    of zeros; repeated rows are each scored; rows with a null id are scored and
    not held out; other columns take no part; an empty table gives an empty
    result, and without labels every score is 0.5.
    """
    score = scorer(df, labels, id_col, text_col, label_id_col, label_col, sample)
    scored = map_texts(df, id_col, text_col, "score double", score, as_bytes=True)
    return scored.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def scorer(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str, sample: int):
    """Fit word vectors and network on ``df``; the function that scores texts."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    vectors = word_vectors(docs)
    known = labels.select(F.col(label_id_col).alias("label_id"), F.col(label_col).alias("label"))
    network = train(docs, known, vectors, "label_id", "label", sample)
    shared = df.sparkSession.sparkContext.broadcast((vectors, network))

    def score(texts):
        vectors, network = shared.value
        x = np.array([features(t, vectors) for t in texts], np.float32).reshape(len(texts), FEATURES)
        return {"score": pa.array(network.score(x), pa.float64())}

    return score


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
              label_col: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text scores at least ``threshold``, as they are."""
    score = scorer(df, labels, id_col, text_col, label_id_col, label_col, sample)
    return (with_texts(df, text_col, "quality_score_ double", lambda texts: {"quality_score_": score(texts)["score"]}, as_bytes=True)
            .filter(F.col("quality_score_") >= threshold).drop("quality_score_"))
