"""Benchmark decontamination with one Aho-Corasick automaton.

Items (test questions and answers) are normalised to words; every run of
``window`` consecutive words of an item is a pattern, an item with fewer words
is one pattern.  A document's normalised text is scanned once; hits are mapped
to word numbers and to code points of the original text.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_batches, with_texts, written

WINDOW = 10
#: Characters of patterns in one automaton.  More patterns are dealt over
#: several automata that scan one after the other, so none outgrows a worker.
PATTERN_CHARS = 32 << 20

#: A word is a run of 0-9, a-z, A-Z (lower-cased) and all beyond ASCII.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                  for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text: bytes | None) -> list[bytes]:
    """Normalised words of a UTF-8 text; null has none."""
    return text.translate(_TO_WORDS).split() if text else []


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """Distinct patterns of ``items``: shard hash, pattern (bytes, words with a
    space before, between and after), words, and the ids of its items as strings."""
    source = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))

    def cut(batches):
        for part in text_batches(batches):
            ids, patterns, lengths = [], [], []
            for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                w = words(text)
                if not w or item is None:
                    continue
                for at in range(max(1, len(w) - window + 1)):
                    run = w[at:at + window]
                    ids.append(item)
                    patterns.append(b" " + b" ".join(run) + b" ")
                    lengths.append(len(run))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(patterns, pa.binary()),
                                              pa.array(lengths, pa.int32())], names=["item", "pattern", "n"])

    return (source.mapInArrow(cut, "item string, pattern binary, n int")
            .groupBy("pattern", "n").agg(F.collect_set("item").alias("items")))


def build(patterns: list[tuple[bytes, int, list[str]]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern, n, items in patterns:
        automaton.add_word(pattern.decode("latin-1"), (n, tuple(items)))
    automaton.make_automaton()
    return automaton


def hits(automaton: ahocorasick.Automaton, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(number of words, word intervals that occur as a pattern, items)."""
    w = words(text)
    if not w or not len(automaton):
        return len(w), [], set()
    hay = (b" " + b" ".join(w) + b" ").decode("latin-1")
    found = list(automaton.iter(hay))
    if not found:
        return len(w), [], set()
    spaces = np.flatnonzero(np.frombuffer(hay.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in found])
    spans = [(int(k) - n, int(k)) for k, (_, (n, _)) in zip(last, found, strict=True)]
    return len(w), spans, {item for _, (_, items) in found for item in items}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def shared_patterns(docs: DataFrame, items: DataFrame, item_col: str, text_col: str, window: int, pattern_chars: int) -> list:
    """Broadcast lists of patterns, each of about ``pattern_chars`` at most."""
    patterns = written(item_windows(items, item_col, text_col, window))
    total = patterns.agg(F.sum(F.length("pattern"))).first()[0] or 0
    count = int(total // pattern_chars) + 1
    shards = []
    for shard in range(count):
        rows = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(count)) == shard).collect()
        shards.append(docs.sparkSession.sparkContext.broadcast([(bytes(r.pattern), r.n, r["items"]) for r in rows]))
    return shards


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  pattern_chars: int = PATTERN_CHARS) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit (words inside any occurrence of a
    pattern), ``items`` (sorted ids, as strings, of the items that occur) and
    ``spans`` (maximal hit passages: first word, word end, first code point,
    code point end in the original text).

    A null or empty text has no words and no hits.  Items without words, or with
    a null id, give no pattern; equal ids count as one item.  Repeated rows are
    each scanned; other columns take no part; an empty table on either side is
    no error.
    """
    ship(docs.sparkSession)
    shards = shared_patterns(docs, items, item_col, item_text_col, window, pattern_chars)
    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    span = pa.struct([("word", pa.int32()), ("word_end", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    fields = (f"_id {id_type}, _text binary, n_words long, n_hit long, items array<string>, "
              "spans array<struct<word:int,word_end:int,start:int,end:int>>")
    for number, shard in enumerate(shards):

        def search(batches, shared=shard, first=number == 0, last=number == len(shards) - 1):
            automaton = build(shared.value)
            for part in text_batches(batches):
                texts = part.column(1).to_pylist()
                empty = [None] * len(texts)
                known = empty if first else part.column(4).to_pylist()
                before = empty if first else part.column(5).to_pylist()
                counts, n_hit, names, spans = [], [], [], []
                for text, seen, old in zip(texts, known, before, strict=True):
                    n, found, who = hits(automaton, text)
                    found = merged(found + [(x["word"], x["word_end"]) for x in old or ()])
                    counts.append(n)
                    n_hit.append(sum(b - a for a, b in found))
                    names.append(sorted(who.union(seen or ())))
                    at = [m.span() for m in _WORD.finditer(text.decode())] if found else []
                    spans.append([{"word": a, "word_end": b, "start": at[a][0], "end": at[b - 1][1]} for a, b in found])
                keep = pa.nulls(len(texts), pa.binary()) if last else part.column(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), keep, pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
                    names=["_id", "_text", "n_words", "n_hit", "items", "spans"])

        out = out.mapInArrow(search, fields)
    return out.drop("_text").withColumnRenamed("_id", id_col)


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               window: int = WINDOW, pattern_chars: int = PATTERN_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no pattern of the items occurs, as they are."""
    for shard in shared_patterns(docs, items, item_col, item_text_col, window, pattern_chars):
        known: dict = {}

        def search(texts, shared=shard, known=known):
            if "automaton" not in known:
                known["automaton"] = build(shared.value)
            return {"hit_": pa.array([bool(hits(known["automaton"], t)[1]) for t in texts], pa.bool_())}

        docs = with_texts(docs, text_col, "hit_ boolean", search, as_bytes=True).filter("not hit_").drop("hit_")
    return docs
