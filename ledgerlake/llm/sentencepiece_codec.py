"""SentencePiece encoding and decoding.

The pieces of a model form an Aho-Corasick automaton.  Encoding is one pass
over the text: at each position the automaton's output links give every piece
that ends there, and each relaxes the best score of that position; the path
back from the end is the most probable segmentation (Viterbi).  Characters that
no piece covers are written as bytes.  Decoding restores the text exactly.

A model whose file holds merge ranks instead of log probabilities (BPE) is read
as a unigram model with Zipf-Mandelbrot probabilities of those ranks; nothing is
trained.
"""

from __future__ import annotations

import math
import re
import struct
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Segmentations of text chunks that a worker remembers.
CACHE = 400_000
#: A model of more bytes is refused, as it is sent to every executor.
MODEL_BYTES = 64 << 20

SPACE = "▁"
#: Fixed values of the model format: kinds of piece, kinds of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: An unknown character's score below the worst piece; offset of ranks in the probabilities.
UNKNOWN_PENALTY, ZIPF_OFFSET = 10.0, 2.7


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message's fields."""

    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def read_model(data: bytes) -> tuple[list[tuple[str, float, int]], int]:
    """((piece, score, kind) by id, kind of model).  A model that normalises
    text or drops white space cannot be decoded exactly and is refused."""
    pieces, kind = [], UNIGRAM
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            normalizer = dict(_fields(value))
            if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1) or not normalizer.get(5, 1):
                raise ValueError("the model's normaliser changes the text")
    if kind not in (UNIGRAM, BPE):
        raise ValueError(f"unsupported kind of model: {kind}")
    if kind == BPE:
        # Merges come in order of their rank: a file's order is its frequency order.
        normal = [k for k, (_, _, t) in enumerate(pieces) if t == NORMAL]
        total = math.log(sum(1 / (r + ZIPF_OFFSET) for r in range(1, len(normal) + 1)))
        for rank, k in enumerate(normal, 1):
            pieces[k] = (pieces[k][0], -math.log(rank + ZIPF_OFFSET) - total, NORMAL)
    return pieces, kind


class Codec:
    """Encoder and decoder of one model; lives in a Python worker."""

    def __init__(self, model: bytes, cache: int = CACHE):
        pieces, _ = read_model(model)
        self.automaton = ahocorasick.Automaton()
        self.bytes = [-1] * 256
        self.table: list[bytes] = []
        worst = min(score for _, score, kind in pieces if kind in (NORMAL, USER_DEFINED))
        for k, (piece, score, kind) in enumerate(pieces):
            if kind == BYTE:
                self.bytes[int(piece[1:-1], 16)] = k
                self.table.append(bytes([int(piece[1:-1], 16)]))
                continue
            self.table.append(piece.replace(SPACE, " ").encode() if kind in (NORMAL, USER_DEFINED, UNUSED) else b"")
            if kind in (NORMAL, USER_DEFINED) and piece:
                self.automaton.add_word(piece, (len(piece), k, score))
        self.automaton.make_automaton()
        if min(self.bytes) < 0:
            raise ValueError("the model has no byte pieces, so it cannot write every text")
        self.unknown = worst - UNKNOWN_PENALTY
        usable = [p for p, _, kind in pieces if kind in (NORMAL, USER_DEFINED)]
        # No piece goes on from another character to a space or beyond a line feed:
        # the best path of a text is then that of its chunks in a row.
        self.split = not any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p in usable)
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        codec = self

        class Cache(dict):
            def __missing__(self, chunk):
                if len(self) >= cache:
                    self.clear()
                ids = self[chunk] = codec.viterbi(chunk)
                return ids

        self.known = Cache()
        self.literal = tuple(self.bytes[b] for b in SPACE.encode())

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation of ``text``, where spaces are escaped.
        Of equal scores the piece that starts first stays."""
        n, unknown = len(text), self.unknown
        best = [0.0] + [-math.inf] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0  # positions up to here have had their unknown character considered
        for end, (size, piece, score) in self.automaton.iter(text):
            end += 1
            while done < end - 1:  # nothing more ends there
                done += 1
                if best[done - 1] + unknown > best[done]:
                    best[done], back[done] = best[done - 1] + unknown, (done - 1, -1)
            value = best[end - size] + score
            if value > best[end]:
                best[end], back[end] = value, (end - size, piece)
        while done < n:
            done += 1
            if best[done - 1] + unknown > best[done]:
                best[done], back[done] = best[done - 1] + unknown, (done - 1, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece < 0:
                ids += [self.bytes[b] for b in reversed(text[start:at].encode())]
            else:
                ids.append(piece)
            at = start
        return tuple(reversed(ids))

    def _escaped(self, text: str):
        text = text.replace(" ", SPACE)
        if not text:
            return ()
        return chain.from_iterable(map(self.known.__getitem__, self.chunks(text))) if self.split else self.viterbi(text)

    def encode(self, text: str) -> list[int]:
        """Ids of ``text`` with a space put before it; [] for an empty text.  The
        escape sign itself, if the text has it, is written as bytes."""
        if not text:
            return []
        if SPACE not in text:
            return list(self._escaped(" " + text))
        parts = text.split(SPACE)
        ids = list(self._escaped(" " + parts[0]))
        for part in parts[1:]:
            ids += self.literal
            ids += self._escaped(part)
        return ids

    def decode(self, ids) -> str:
        """The text that was encoded; control pieces have none."""
        table = self.table
        return b"".join([table[k] for k in ids])[1:].decode("utf-8", "replace")


def load(path: str = MODEL) -> bytes:
    """The model file, read on the driver; executors need no copy of it."""
    with open(path, "rb") as f:
        data = f.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"a model of more than {MODEL_BYTES} bytes")
    return data


def encode(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           check: bool = False) -> DataFrame:
    """Per row of ``df``: id, ``token_ids`` and ``n_tokens``; with ``check`` also
    ``exact``, whether decoding gives the text again (done in the same task, so
    no token is moved for it).

    A null text has null ids, no tokens and a null ``exact``; an empty one has an
    empty list.  Repeated rows are each encoded, other columns take no part, an
    empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        codec = _codec(shared.value)
        flat, counts, exact = [np.empty(0, np.int32)], [], []
        for text in texts:
            ids = codec.encode(text or "")
            counts.append(len(ids))
            flat.append(np.array(ids, np.int32))
            if check:
                exact.append(None if text is None else codec.decode(ids) == text)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        missing = pa.array([t is None for t in texts], pa.bool_())
        out = {"token_ids": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat)), mask=missing),
               "n_tokens": pa.array(counts, pa.int64())}
        return out | ({"exact": pa.array(exact, pa.bool_())} if check else {})

    return map_texts(df, id_col, text_col, "token_ids array<int>, n_tokens long" + ", exact boolean" * check, run)


def decode(df: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Per row of ``df``: id and ``text``, null where the ids are null."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        codec = _codec(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [None if ids is None else codec.decode(ids) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["_id", "text"])

    return (df.selectExpr(f"`{id_col}` as _id", f"`{ids_col}` as _ids")
            .mapInArrow(run, f"_id {id_type}, text string").withColumnRenamed("_id", id_col))


_CODECS: dict[int, Codec] = {}


def _codec(model: bytes) -> Codec:
    """The codec of a model, kept while the worker lives."""
    key = hash(model)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]
