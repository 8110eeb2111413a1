"""Removal of passages that an earlier document has, by FM-indexes over shards.

1. Equal texts: all but the copies with the smallest id are removed whole.
2. Every window of ``window`` words has an anchor, the least hash of the
   5-grams in it, so equal windows have equal anchors.  Anchors seen in two or more
   documents are kept in a Bloom filter of fixed size; windows with other anchors
   are found nowhere else.
3. Maximal runs of windows with one anchor are segments.  Distinct segments are
   dealt to shards by their anchor: a window can occur only in the shard of its
   anchor.  Anchors of more words than a shard may have are hot: each of their
   windows is a segment of its own, dealt by its hash, with the least document
   aggregated before the shuffle.  Each shard has a compressed FM-index of its segments (suffixes in the
   order of their first 16 words, Burrows-Wheeler transform in a wavelet matrix of
   packed bits with counts); the segments stream through it again, and backward
   search narrows each window's interval until it is found or known to be alone.
   The least document id of the interval tells whether an earlier one has it.
4. The intervals go back to the documents, where covered words are left out.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_batches, written
from .words import runs, word_hashes

WINDOW, GRAM = 13, 5
#: Words in one shard's index.  An anchor with more is dealt by window, not searched in a shard.
SHARD_WORDS = 400_000
#: Bloom filter: 256 segments of so many bits, probes for each key; with more keys
#: than one for every 8 bits it is left out, and every window is searched.
SEGMENT_BITS, PROBES = 1 << 19, 4
#: Id lists up to this length (8 bytes each) are broadcast, longer ones shuffled.
BROADCAST_IDS = 1_000_000
#: Windows searched at once; small arrays stay in the processor's cache.
QUERIES = 1 << 16

_ONE = np.uint64(1)


def split(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, unchanged; null has none."""
    return text.split() if text else []


def anchors(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor of every window of ``window`` words, from the words' hashes."""
    if len(hashes) < window:
        return np.empty(0, np.uint64)
    gram = min(GRAM, window)
    least, span, grams = runs(hashes, gram), 1, window - gram + 1
    while span < grams:
        step = min(span, grams - span)
        least = np.minimum(least[:len(least) - step], least[step:])
        span += step
    return least


def identity(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _probes(keys: np.ndarray):
    """Segment and bits of keys in the filter."""
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    segment = (keys >> np.uint64(56)).astype(np.int64)
    first, step = keys & np.uint64(0xFFFFFFF), ((keys >> np.uint64(28)) & np.uint64(0xFFFFFFF)) | _ONE
    return segment, [((first + np.uint64(k) * step) % np.uint64(SEGMENT_BITS)).astype(np.int64) for k in range(PROBES)]


def _bloom(repeated: DataFrame) -> np.ndarray | None:
    """The filter of the anchors, 16 MB; None if they are too many for it."""
    if repeated.count() * 8 > 256 * SEGMENT_BITS:
        return None

    def build(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, bits = _probes(batch.column(0).to_numpy().view(np.uint64))
            for s in np.unique(segment).tolist():
                held = parts.setdefault(s, np.zeros(SEGMENT_BITS, bool))
                for b in bits:
                    held[b[segment == s]] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int32()), pa.array([np.packbits(p, bitorder="little").tobytes() for p in parts.values()], pa.binary())],
            names=["segment", "bits"])

    whole = np.zeros((256, SEGMENT_BITS // 8), np.uint8)
    for row in repeated.coalesce(4).mapInArrow(build, "segment int, bits binary").toLocalIterator():
        whole[row.segment] |= np.frombuffer(row.bits, np.uint8)
    return whole


def _in_bloom(whole: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    if whole is not None and len(keys):
        segment, bits = _probes(keys)
        for b in bits:
            found &= (whole[segment, b >> 3] >> (b & 7)) & 1 == 1
    return found


def _segments(text: bytes | None, bloom: np.ndarray | None, window: int, hot: np.ndarray, of_hot: bool | None = None):
    """(anchor, first window, the words) of the runs of windows that may occur
    elsewhere; windows with anchors in ``hot`` (sorted) are each a run.
    ``of_hot``: only those with such an anchor, or only the others."""
    hashes, first, last = word_hashes(text)
    anchor = anchors(hashes, window)
    if not len(anchor):
        return
    start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    keep = np.flatnonzero(_in_bloom(bloom, anchor[start]))
    end = np.append(start[1:], len(anchor))[keep]
    start = start[keep]
    if len(hot) or of_hot:
        is_hot = np.isin(anchor[start], hot)
        if of_hot is not None:
            start, end, is_hot = (x[is_hot == of_hot] for x in (start, end, is_hot))
        times = np.where(is_hot, end - start, 1)
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        end = np.where(np.repeat(is_hot, times), np.repeat(start, times) + step + 1, np.repeat(end, times))
        start = np.repeat(start, times) + step
    for a, at, x, y in zip(anchor[start].view(np.int64).tolist(), start.tolist(), first[start].tolist(),
                           last[end + window - 2].tolist(), strict=True):
        yield a, at, b" ".join(text[x:y].split())


class FMIndex:
    """FM-index of a sequence of symbols, for patterns of up to 16 symbols."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        n = len(symbols)
        key = symbols.astype(np.int64)
        for step in (1, 2, 4, 8):
            after = np.zeros(n, np.int64)
            after[:-step] = key[step:] + 1
            both = key * (int(key.max()) + 2) + after
            order = np.argsort(both, kind="stable")
            ranked = both[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]).astype(np.int64)]))
            key = rank
        self.order = np.argsort(key, kind="stable")
        self.size = n
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])[:-1]
        column = symbols[self.order - 1]
        self.levels = []
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (column >> bit & 1).astype(bool)
            packed = np.packbits(np.concatenate([ones, np.zeros(64 - n % 64, bool)]), bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1]
            self.levels.append((bit, packed, counts.astype(np.int32), n - int(ones.sum())))
            column = np.concatenate([column[~ones], column[ones]])
        every = np.arange(alphabet)
        self.first = self._down(np.zeros(alphabet, np.int64), every)

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Positions carried through the wavelet matrix along the symbols' bits."""
        for bit, packed, counts, zeros in self.levels:
            word = at >> 6
            ones = counts[word] + np.bitwise_count(packed[word] & ((_ONE << (at & 63).astype(np.uint64)) - _ONE))
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray):
        """Intervals of the patterns with ``symbol`` put before them."""
        both = self._down(np.concatenate([low, high]), np.concatenate([symbol, symbol]))
        base = self.before[symbol] - self.first[symbol]
        return both[:len(low)] + base, both[len(low):] + base


def least_documents(index: FMIndex, docs: np.ndarray, symbols: np.ndarray, at: np.ndarray, own: np.ndarray,
                    window: int = WINDOW) -> np.ndarray:
    """Per window (its place in ``symbols``): the least document that has it in
    the index, or its own if none is less.  ``docs``: least document of each
    indexed position; ``own``: that of each window."""
    by_suffix = np.append(docs[index.order], np.iinfo(np.int64).max)
    result = own.copy()
    for cut in range(0, len(at), QUERIES):
        live = np.arange(cut, min(cut + QUERIES, len(at)))
        low, high = np.zeros(len(live), np.int64), np.full(len(live), index.size, np.int64)
        for k in range(window - 1, -1, -1):
            low, high = index.extend(low, high, symbols[at[live] + k])
            # One occurrence left is a window's own if the index has it, and then no other document's.
            go_on = high > low
            few = np.flatnonzero(go_on & (high - low <= 4))
            if len(few) and k:
                lowest = by_suffix[low[few]].copy()
                for j in range(1, 4):
                    lowest = np.where(low[few] + j < high[few], np.minimum(lowest, by_suffix[np.minimum(low[few] + j, index.size)]), lowest)
                go_on[few[lowest >= own[live[few]]]] = False
            if not go_on.all():
                live, low, high = live[go_on], low[go_on], high[go_on]
            if not len(live):
                break
        if len(live):
            lowest = np.minimum.reduceat(by_suffix, np.stack([low, high], axis=1).ravel())[::2]
            result[live] = np.minimum(result[live], lowest)
    return result


def _search_shard(segments: list[bytes], docs: list[int], window: int) -> list[np.ndarray]:
    """Per segment, the least document of each of its windows.  More words than a
    shard may have are indexed block by block, and all stream through each index."""
    known: dict[bytes, int] = {}
    words = [s.split(b" ") for s in segments]
    lengths = np.array([len(w) for w in words])
    flat = np.zeros(int((lengths + 1).sum()), np.int64)  # 0 ends a segment
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    inside = np.ones(len(flat), bool)
    inside[starts + lengths] = False
    flat[inside] = np.fromiter((known.setdefault(w, len(known) + 1) for w in chain.from_iterable(words)), np.int64, int(lengths.sum()))
    del words
    owner = np.repeat(np.array(docs, np.int64), lengths + 1)
    count = lengths - window + 1
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(int(count.sum()))
    own = owner[at]
    least = own
    block = 0
    while block < len(segments):
        stop = int(np.searchsorted(starts, starts[block] + SHARD_WORDS))
        stop = max(stop, block + 1)
        end = starts[stop] if stop < len(segments) else len(flat)
        part = slice(int(starts[block]), int(end))
        index = FMIndex(flat[part], len(known) + 1)
        least = np.minimum(least, least_documents(index, owner[part], flat, at, own, window))
        block = stop
    return np.split(least, np.cumsum(count)[:-1])


def _shards(batches, window):
    """From rows (anchor, segment, words, low, high) sorted by anchor and segment:
    (segment, least documents of its windows) where some document loses a window."""
    held: list[tuple[bytes, bytes, int, int]] = []
    size, last = 0, None

    def flush():
        distinct: dict[bytes, list] = {}
        for segment, words, low, high in held:
            old = distinct.setdefault(segment, [words, low, high])
            old[1], old[2] = min(old[1], low), max(old[2], high)
        found = _search_shard([d[0] for d in distinct.values()], [d[1] for d in distinct.values()], window)
        out = [(s, least) for (s, (_, _, high)), least in zip(distinct.items(), found, strict=True) if (least < high).any()]
        offsets = np.concatenate([[0], np.cumsum([len(v) for _, v in out])]).astype(np.int32)
        flat = np.concatenate([np.empty(0, np.int64), *(v for _, v in out)])
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in out], pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
            names=["segment", "least"])

    for batch in batches:
        for anchor, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if anchor != last and size >= SHARD_WORDS:
                yield flush()
                held, size = [], 0
            last = anchor
            held.append(tuple(row))
            size += row[1].count(b" ") + 1
    if held:
        yield flush()


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``df``: id, n_words, n_removed, ``kept_text`` for rows that lose
    words (null where nothing is removed), ``kept_sha256`` of the kept words
    joined by single spaces, and ``removed``, the word intervals taken out.

    A word goes if a window of ``window`` words that covers it also starts in a
    row with a smaller id; windows are judged on the input.  A null or empty text
    has no words; a text with fewer words than a window stays; repeated rows have
    equal ids, so neither removes the other's words.  A row with a null id is
    returned as it is and removes nothing.  Other columns take no part; an empty
    table gives an empty result.
    """
    if not GRAM <= window <= 16:
        raise ValueError("windows of 5 to 16 words")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def measure(texts):
        count, digests, sums = [], [], []
        for text in texts:
            words = split(text)
            joined = b" ".join(words)
            count.append(len(words))
            digests.append(xxhash.xxh3_128_digest(joined) if len(words) >= window else None)
            sums.append(hashlib.sha256(joined).hexdigest())
        return {"n_words": pa.array(count, pa.int64()), "digest": pa.array(digests, pa.binary()), "sha": pa.array(sums)}

    measured = written(map_texts(docs, "id", "text", "n_words long, digest binary, sha string", measure, as_bytes=True))
    able = measured.filter("id is not null and digest is not null")
    first = able.groupBy("digest").agg(F.min("id").alias("first"))
    copies = written(able.join(first, "digest").filter("id > first").select("id", "digest").distinct())
    copy_ids = copies.select("id").distinct()
    few = copy_ids.count() <= BROADCAST_IDS
    distinct = (docs.filter("id is not null").select("id", F.col("text").cast("binary").alias("text"))
                .join(F.broadcast(copy_ids) if few else copy_ids, "id", "left_anti"))
    # An id with several texts, of which some are copies, keeps the others in.
    mixed = able.join(copy_ids, "id", "left_semi").join(copies, ["id", "digest"], "left_anti").select("id").distinct()
    mixed = written(mixed)
    if not mixed.isEmpty():
        distinct = distinct.union(docs.join(mixed, "id", "left_semi").select("id", F.col("text").cast("binary")))

    def list_anchors(batches):
        for part in text_batches(batches):
            found, words = [], []
            for t in part.column(1).to_pylist():
                anchor = anchors(word_hashes(t)[0], window)
                start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.empty(0, np.int64)
                own, place = np.unique(anchor[start], return_inverse=True)
                found.append(own)
                words.append(np.bincount(place, np.diff(np.append(start, len(anchor))) + window - 1, len(own)).astype(np.int64))
            ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(ids, [len(f) for f in found])),
                 pa.array(np.concatenate(words))], names=["anchor", "id", "words"])

    repeated = written(distinct.mapInArrow(list_anchors, "anchor long, id long, words long").groupBy("anchor")
                       .agg(F.min("id").alias("a"), F.max("id").alias("b"), F.sum("words").alias("words"))
                       .filter("a < b").select("anchor", "words"))
    context = df.sparkSession.sparkContext
    bloom = context.broadcast(_bloom(repeated.select("anchor")))
    # At most one for every SHARD_WORDS words of the input.
    large = [r.anchor for r in repeated.filter(F.col("words") > SHARD_WORDS).select("anchor").toLocalIterator()]
    hot = context.broadcast(np.sort(np.array(large, np.int64).view(np.uint64)))

    def index_rows(batches):
        """Distinct segments of a block of texts with their least and largest id."""
        for part in text_batches(batches):
            held: dict[bytes, list] = {}
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for anchor, _, run in _segments(text, bloom.value, window, hot.value, False):
                    row = held.setdefault(xxhash.xxh3_128_digest(run), [anchor, run, doc, doc])
                    row[2], row[3] = min(row[2], doc), max(row[3], doc)
            rows = [pa.array([r[k] for r in held.values()], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([rows[0], pa.array(list(held), pa.binary()), *rows[1:]],
                                             names=["anchor", "segment", "words", "low", "high"])

    found = written(distinct.mapInArrow(index_rows, "anchor long, segment binary, words binary, low long, high long")
                    .repartition(F.col("anchor")).sortWithinPartitions("anchor", "segment")
                    .mapInArrow(lambda batches: _shards(batches, window), "segment binary, least array<long>"))

    def hot_windows(batches):
        """Distinct windows with a hot anchor of a block of texts, with their least and largest id."""
        for part in text_batches(batches):
            held: dict[bytes, list[int]] = {}
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for _, _, run in _segments(text, bloom.value, window, hot.value, True):
                    row = held.setdefault(xxhash.xxh3_128_digest(run), [doc, doc])
                    row[0], row[1] = min(row[0], doc), max(row[1], doc)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), *(pa.array([r[k] for r in held.values()], pa.int64()) for k in (0, 1))],
                                             names=["segment", "low", "high"])

    if large:
        found = found.unionByName(written(
            distinct.mapInArrow(hot_windows, "segment binary, low long, high long").groupBy("segment")
            .agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("segment", F.array("low").alias("least"))))

    def occurrences(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)],
                                              names=["id", "digest", "start", "segment"])

        for part in text_batches(batches):
            rows: list[list] = [[], [], [], []]
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                digest = None
                for _, at, run in _segments(text, bloom.value, window, hot.value):
                    digest = digest or identity(split(text))
                    for column, value in zip(rows, (doc, digest, at, xxhash.xxh3_128_digest(run)), strict=True):
                        column.append(value)
                    if len(rows[0]) >= QUERIES:
                        yield batch(rows)
                        rows = [[], [], [], []]
            yield batch(rows)

    lost = (distinct.mapInArrow(occurrences, "id long, digest binary, start int, segment binary").join(found, "segment")
            .withColumn("hit", F.expr("filter(transform(least, (m, k) -> if(m < id, start + k, -1)), x -> x >= 0)"))
            .filter("size(hit) > 0").groupBy("id", "digest").agg(F.flatten(F.collect_list("hit")).alias("hit")))
    lost = written(lost.unionByName(copies.join(mixed, "id", "left_semi").select("id", "digest", F.array(F.lit(-1)).alias("hit")))
                   .groupBy("id").agg(F.collect_list(F.struct("digest", "hit")).alias("lost")))
    ids = lost.select("id")
    hint = F.broadcast if ids.count() <= BROADCAST_IDS else lambda x: x
    affected = (docs.select("id", F.col("text").cast("binary").alias("text")).join(hint(ids), "id", "left_semi")
                .join(lost, "id").select("id", "text", "lost"))

    def assemble(batches):
        span = pa.list_(pa.struct([("word", pa.int32()), ("word_end", pa.int32())]))
        for part in text_batches(batches):
            out: list[list] = [[], [], [], [], []]
            for text, lost_rows in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                words = split(text)
                digest = identity(words)
                drop = np.zeros(len(words) + 1, np.int32)
                for row in lost_rows:
                    if row["digest"] == digest and row["hit"] == [-1]:
                        drop[0] += 1
                    elif row["digest"] == digest:
                        hit = np.unique(np.array(row["hit"], np.int64))
                        drop[hit] += 1
                        drop[hit + window] -= 1
                gone = np.cumsum(drop[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                for column, value in zip(out, (len(words), int(gone.sum()), kept.decode() if gone.any() else None, hashlib.sha256(kept).hexdigest(),
                                               [{"word": int(a), "word_end": int(b)} for a, b in edge.reshape(-1, 2)]), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part.column(0)] + [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string(), span), strict=True)],
                names=["id", "n_words", "n_removed", "kept_text", "kept_sha256", "removed"])

    fields = "n_words long, n_removed long, kept_text string, kept_sha256 string, removed array<struct<word:int,word_end:int>>"
    changed = affected.mapInArrow(assemble, "id long, " + fields)
    rest = measured.join(hint(ids), "id", "left_anti")
    is_copy = copies.select("id", "digest", F.lit(True).alias("copy"))
    rest = (rest.join(is_copy, ["id", "digest"], "left")
            .select("id", "n_words", F.expr("if(copy, n_words, 0L)").alias("n_removed"), F.expr("if(copy, '', null)").alias("kept_text"),
                    F.expr(f"if(copy, '{hashlib.sha256(b'').hexdigest()}', sha)").alias("kept_sha256"),
                    F.expr("if(copy, array(named_struct('word', 0, 'word_end', cast(n_words as int))), array())").alias("removed")))
    return changed.unionByName(rest).withColumnRenamed("id", id_col)
