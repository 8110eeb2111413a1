"""Jaccard join of documents on word n-grams, and the groups that its links form.

1. One scan gives every document's shingle count and the digest of its set.
   Documents with equal sets are one class, named by its smallest id.
2. A second scan gives each class's prefix: shingles in one global order, of
   which a pair that can link must share one (prefix filter).  Shingles seen
   often come last in the order, so a passage that many texts share brings few
   of them together.
3. Per shared shingle, documents sorted by size are tiles.  Sizes and positions
   in the prefix bound the overlap; then the bit counts of hashed bitmap
   signatures bound it from above; what is left is verified by intersecting
   the sorted arrays of shingles exactly.  A shingle of many documents is cut
   into tiles of bounded size, joined band by band; from each pair of tiles only
   a spanning forest goes on at first, and then what that left unconnected.
4. Links become components by label propagation with pointer jumping.

Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, ship, text_batches, with_texts, written
from .words import runs, word_hashes

#: Links need PERCENT * union <= 100 * intersection; WORDS words make a shingle.
WORDS, PERCENT = 5, 75
#: In one block of texts, shingles in so many distinct sets are counted for the order.
SEEN = 2
#: So many of the most frequent shingles are ordered last.  Any order gives the same links.
FREQUENT = 200_000
#: A shingle of more documents is joined tile by tile; documents in a tile.
SMALL, TILE = 12, 2048
#: Id lists up to this length (8 bytes each) are broadcast, longer ones shuffled.
BROADCAST_IDS = 1_000_000
#: Bits of a signature for each shingle (rounded up to a power of two), least and most.
BITS_PER_SHINGLE, LEAST_BITS, MOST_BITS = 2, 256, 1 << 16


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes: of ``words`` words, or of all if there are
    fewer; A-Z lower-cased, words split at ASCII white space."""
    hashed = word_hashes(text.lower() if text else None)[0]
    return np.unique(runs(hashed, min(words, len(hashed)))) if len(hashed) else hashed


def least_overlap(a, b, percent: int = PERCENT):
    """Smallest intersection with which sets of sizes ``a`` and ``b`` link."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix(shingle_set: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles in the global order (rare by hash, then frequent by
    hash), so many that a linked document must share one of them."""
    n = len(shingle_set)
    keep = n - -(-percent * n // 100) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingle_set), len(frequent) - 1)
        often = frequent[at] == shingle_set
        if often.any():
            shingle_set = np.concatenate([shingle_set[~often], shingle_set[often]])
    return shingle_set[:keep]


def signature(shingle_set: np.ndarray) -> bytes:
    """Parity bitmap: each shingle flips one bit."""
    bits = LEAST_BITS
    while bits < BITS_PER_SHINGLE * len(shingle_set) and bits < MOST_BITS:
        bits *= 2
    count = np.bincount((shingle_set >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(count.astype(np.uint8), bitorder="little").tobytes()


def _folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of fewer bits; halves add up modulo 2, as the hashes do."""
    while len(bitmap) > words:
        bitmap = bitmap[:len(bitmap) // 2] ^ bitmap[len(bitmap) // 2:]
    return bitmap


def most_overlap(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """Upper bound of the intersection: bits that differ are shingles that differ."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    differ = int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum())
    return (n_a + n_b - differ) // 2


def _allowed(n, pos, rows: slice, percent: int) -> np.ndarray:
    """Which of all documents of a shingle each of ``rows`` may link with, by sizes
    and by the shingle's position in the prefixes (as the first one in common)."""
    need = least_overlap(n[rows, None], n[None], percent)
    return ((np.minimum((n - pos)[rows, None], (n - pos)[None]) >= need) & (np.minimum(n[rows, None], n[None]) >= need)
            & (np.arange(len(n))[rows, None] != np.arange(len(n))[None]))


def _grouped_pairs(batches, percent):
    """From rows (token, n, id, pos) sorted by token, n, id: pairs that sizes and
    positions allow, of small groups; members with their tile, of large ones."""
    seen: list[np.ndarray] = []
    carry = None
    large, offset = None, 0

    def members(rows, first):
        tile = (first + np.arange(len(rows[0]))) // TILE
        return {"a": rows[2], "token": rows[0], "n": rows[1], "pos": rows[3], "tile": tile.astype(np.int32)}

    def pairs(rows):
        token, n, doc, pos = rows
        found = []
        for d in range(1, SMALL):
            same = np.flatnonzero(token[d:] == token[:-d])
            if not len(same):
                break
            i, j = same, same + d  # n[i] <= n[j]
            need = least_overlap(n[i], n[j], percent)
            can = (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need) & (n[i] >= need) & (doc[i] != doc[j])
            i, j = i[can], j[can]
            found.append(np.stack([np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])]))
        return np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)

    def batch(a, b=None, token=None, n=None, pos=None, tile=None):
        size = len(a)
        arrays = [pa.array(v, t) if v is not None else pa.nulls(size, t) for v, t in
                  ((a, pa.int64()), (b, pa.int64()), (token, pa.int64()), (n, pa.int64()), (pos, pa.int64()), (tile, pa.int32()))]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "token", "n", "pos", "tile"])

    def chunks():
        held, size = [], 0
        for b in batches:
            held.append([b.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
            size += b.num_rows
            if size >= 200_000:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held, size = [], 0
        yield [np.concatenate(c) for c in zip(*held, strict=True)] if held else [np.empty(0, np.int64)] * 4

    def parts():
        before = None
        for rows in chunks():
            if before is not None:
                yield before, False
            before = rows
        yield before, True

    for rows, last in parts():
        if carry is not None:
            rows = [np.concatenate(c) for c in zip(carry, rows, strict=True)]
            carry = None
        if len(rows[0]):
            once = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1])])
            rows = [c[once] for c in rows]
        if large is not None and len(rows[0]):
            more = int(np.searchsorted(rows[0], large, "right"))
            if more:
                yield batch(**members([c[:more] for c in rows], offset))
                offset += more
            if more < len(rows[0]):
                large = None
            rows = [c[more:] for c in rows]
        if not len(rows[0]):
            continue
        start = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))
        size = np.diff(np.append(start, len(rows[0])))
        if not last:
            if size[-1] <= SMALL:
                carry = [c[start[-1]:] for c in rows]
            else:
                large, offset = rows[0][-1], int(size[-1])
                yield batch(**members([c[start[-1]:] for c in rows], 0))
            rows = [c[:start[-1]] for c in rows]
            start, size = start[:-1], size[:-1]
        for k in np.flatnonzero(size > SMALL):
            group = [c[start[k]:start[k] + size[k]] for c in rows]
            if size[k] <= TILE:  # else the tiles see to it
                parts_of = [slice(x, x + 256) for x in range(0, int(size[k]), 256)]
                some = np.concatenate([_allowed(group[1], group[3], x, percent).any(axis=1) for x in parts_of])
                group = [c[some] for c in group]
            if len(group[0]):
                yield batch(**members(group, 0))
        few = np.repeat((size > 1) & (size <= SMALL), size)
        found = pairs([c[few] for c in rows])
        if found.shape[1]:
            seen.append(found)
            if sum(x.shape[1] for x in seen) > 500_000 or last:
                both = np.unique(np.concatenate(seen, axis=1), axis=1)
                yield batch(a=both[0], b=both[1])
                seen = []
    if seen:
        both = np.unique(np.concatenate(seen, axis=1), axis=1)
        yield batch(a=both[0], b=both[1])


def _cells(batches):
    """Runs of rows with one (token, i, j), the first three columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in range(3)]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for start, stop in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
            if start == stop:
                continue
            key = tuple(int(k[start]) for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def _cell_pairs(cell: pa.Table, forest: bool, percent: int) -> tuple[np.ndarray, bool]:
    """Pairs in one pair of tiles that sizes, positions and bit counts allow, and
    whose labels differ; with ``forest`` only a spanning forest, likeliest first,
    and whether there are more."""
    ids, n = cell["a"].to_numpy(), cell["n"].to_numpy()
    order = np.lexsort((ids, n))
    ids, n, pos, label, tile = (cell[c].to_numpy()[order] for c in ("a", "n", "pos", "label", "tile"))
    none = np.empty((2, 0), np.int64)
    if (label == label[0]).all():
        return none, False
    across = cell["i"][0].as_py() != cell["j"][0].as_py()
    raw = cell["signature"].to_pylist()
    bitmaps = [np.frombuffer(raw[k], np.uint64) for k in order]
    words = min(map(len, bitmaps))
    bits = np.stack([_folded(b, words) for b in bitmaps])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(ids), 64):
        rows = slice(start, start + 64)
        can = _allowed(n, pos, rows, percent) & (label[rows, None] != label[None])
        can &= np.arange(len(ids))[rows, None] < np.arange(len(ids))[None]
        if across:  # pairs within a tile have a cell of their own
            can &= tile[rows, None] != tile[None]
        i, j = np.nonzero(can)
        for cut in range(0, len(i), 8192):
            p, q = i[cut:cut + 8192] + start, j[cut:cut + 8192]
            differ = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64)
            ok = (n[p] + n[q] - differ) // 2 >= least_overlap(n[p], n[q], percent)
            found.append((p[ok], q[ok], (differ / (n[p] + n[q]))[ok]))
    if not found:
        return none, False
    p, q, apart = (np.concatenate(c) for c in zip(*found, strict=True))
    if forest and len(p):
        root = list(range(len(ids)))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        keep = []
        for k in np.argsort(apart, kind="stable").tolist():
            x, y = top(int(p[k])), top(int(q[k]))
            if x != y:
                root[x] = y
                keep.append(k)
        more = len(keep) < len(p)
        p, q = p[keep], q[keep]
    else:
        more = False
    return np.stack([np.minimum(ids[p], ids[q]), np.maximum(ids[p], ids[q])]), more


def _tile_pairs(batches, forest: bool, percent: int):
    """The pairs (a, b) of all cells of a partition, each once; and, with a null a,
    the cells (token, i, j) that have more than their forest."""
    held, size, cells = [], 0, []

    def batch():
        both = np.unique(np.concatenate([*held, np.empty((2, 0), np.int64)], axis=1), axis=1)
        keys = list(zip(*cells, strict=True)) or [(), (), ()]
        none = [None] * len(cells)
        return pa.RecordBatch.from_arrays(
            [pa.array([*both[0].tolist(), *none], pa.int64()), pa.array([*both[1].tolist(), *none], pa.int64())]
            + [pa.array([None] * both.shape[1] + list(k), t) for k, t in zip(keys, (pa.int64(), pa.int32(), pa.int32()), strict=True)],
            names=["a", "b", "token", "i", "j"])

    for cell in _cells(batches):
        found, more = _cell_pairs(cell, forest, percent)
        held.append(found)
        size += found.shape[1]
        if more:
            cells.append(tuple(cell[k][0].as_py() for k in ("token", "i", "j")))
        if size > 200_000:
            yield batch()
            held, size, cells = [], 0, []
    yield batch()


def _listed(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint if they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: bit counts first, then exact intersection."""
    sides = {s: texts.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"),
                             F.col("signature").alias(f"s_{s}")) for s in "ab"}
    bounded = pairs.distinct().join(sides["a"], "a").join(sides["b"], "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def bound(batches):
        for part in batches:
            columns = [part.column(k).to_pylist() for k in range(2, 6)]
            ok = [most_overlap(sa, sb, na, nb) >= least_overlap(na, nb, percent)
                  for na, nb, sa, sb in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok))

    likely = written(bounded.mapInArrow(bound, "a long, b long").distinct())
    whole = {s: texts.select(F.col("id").alias(s), F.col("text").alias(f"t_{s}")) for s in "ab"}
    both = likely.join(whole["a"], "a").join(whole["b"], "b").select("a", "b", "t_a", "t_b")

    def exact(batches):
        for part in text_batches(text_batches(batches, 2), 3):
            known: dict[bytes, np.ndarray] = {}

            def of(text, known=known):
                if text not in known:
                    known[text] = shingles(text, words)
                return known[text]

            ok = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                x, y = of(x), of(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(exact, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in ``links`` (a, b): the smallest id that it reaches.
    Each round takes the least label of the neighbours, then the label's own label."""
    edges = written(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                    .union(links.select("b", "a")).distinct())
    labels = written(edges.groupBy("u").agg(F.min("v").alias("v"))
                     .select(F.col("u").alias("id"), F.least("u", "v").alias("label")))
    while True:
        near = (edges.join(labels.select(F.col("id").alias("v"), "label"), "v")
                .groupBy(F.col("u").alias("id")).agg(F.min("label").alias("near")))
        lower = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = written(lower)
        jumped = written(lower.join(lower.select(F.col("id").alias("label"), F.col("label").alias("next")), "label")
                         .select("id", "old", F.col("next").alias("label")))
        if jumped.filter("label < old").isEmpty():
            return labels
        labels = jumped.select("id", "label")


def _digested(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` (with ``text``) and the digest of each text's shingles, null without any."""
    def digest(texts):
        sets = [shingles(t, words) for t in texts]
        return {"digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())}

    return with_texts(docs, "text", "digest binary", digest, as_bytes=True)


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``df``: id, n_shingles, component_id (smallest id that links
    reach, its own included).

    A null or empty text, or one without words, has no shingles and links with
    nothing; so does a row with a null id, whose component is null.  Repeated
    rows link like any copies; rows of one id with different texts are compared
    each on its own.  Ids must be integers.  Other columns take no part; an
    empty table gives an empty result.
    """
    found = _groups(df, id_col, text_col, words, percent)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))


def _groups(df: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Per row: id, digest (of the shingles; null without any), n, c (component)."""
    ship(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def measure(texts):
        count, digests, sets = [], [], {}
        for text in texts:
            s = shingles(text, words)
            count.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sets.setdefault(digests[-1], s)
        token, times = np.unique(np.concatenate([*sets.values(), np.empty(0, np.uint64)]), return_counts=True)
        often = times >= SEEN
        pairs = [{"token": t, "times": c} for t, c in zip(token[often].view(np.int64).tolist(), times[often].tolist(), strict=True)]
        kind = pa.list_(pa.struct([("token", pa.int64()), ("times", pa.int64())]))
        return {"n": pa.array(count, pa.int64()), "digest": pa.array(digests, pa.binary()),
                "often": pa.array([pairs] + [None] * (len(texts) - 1), kind)}

    measured = written(map_texts(docs, "id", "text", "n long, digest binary, often array<struct<token:long,times:long>>",
                                 measure, as_bytes=True))
    often = (measured.filter("often is not null").select(F.explode("often").alias("o"))
             .groupBy("o.token").agg(F.sum("o.times").alias("times")))
    top = [r.token for r in often.orderBy(F.desc("times"), "token").limit(FREQUENT).select("token").collect()]
    spark = df.sparkSession
    frequent = spark.sparkContext.broadcast(np.sort(np.array(top, np.int64).view(np.uint64)))
    classes = written(measured.filter("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep")))
    copies = written(measured.filter("n > 0").join(classes, "digest").filter("id <> rep").select("id", "digest"))
    distinct = docs.filter("id is not null").join(_listed(copies.select("id").distinct()), "id", "left_anti")
    # an id of several texts may represent one class and hold a copy of another
    mixed = written(copies.select("id").distinct().join(classes.select(F.col("rep").alias("id")), "id", "left_semi"))
    if not mixed.isEmpty():
        own = _digested(docs.join(_listed(mixed), "id", "left_semi"), words).join(copies, ["id", "digest"], "left_anti")
        distinct = distinct.unionByName(own.select(distinct.columns))

    def cut(batches):
        for part in text_batches(batches):
            sets = [shingles(t, words) for t in part.column(1).to_pylist()]
            heads = [prefix(s, frequent.value, percent) if len(s) else s for s in sets]
            sizes = [len(h) for h in heads]
            row = np.repeat(np.arange(len(heads)), sizes)
            starts = np.cumsum([0] + sizes[:-1])
            ids = part.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(heads).view(np.int64)),
                 pa.array(np.array([len(s) for s in sets], np.int64)[row]), pa.array(ids[row].astype(np.int64)),
                 pa.array(np.arange(len(row)) - starts[row])], names=["token", "n", "id", "pos"])

    tokens = distinct.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(
        cut, "token long, n long, id long, pos long")
    found = written(tokens.repartition(F.col("token")).sortWithinPartitions("token", "n", "id")
                    .mapInArrow(lambda batches: _grouped_pairs(batches, percent),
                                "a long, b long, token long, n long, pos long, tile int"))
    pairs = found.filter("b is not null").select("a", "b").distinct()
    large = found.filter("b is null").select("a", "token", "n", "pos", "tile")
    wanted = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(large.select("a")).distinct())

    def sign(texts):
        sets = [shingles(t, words) for t in texts]
        return {"n": pa.array([len(s) for s in sets], pa.int64()),
                "signature": pa.array([signature(s) for s in sets], pa.binary()), "text": pa.array(texts, pa.binary())}

    texts = written(map_texts(docs.join(_listed(wanted), "id", "left_semi"), "id", "text",
                              "n long, signature binary, text binary", sign, as_bytes=True).filter("n > 0"))
    links = None
    if large.isEmpty():
        links = _verified(pairs, texts, words, percent)
    else:
        bands = large.groupBy("token", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most"))
        low = bands.select("token", F.col("tile").alias("i"), F.col("most").alias("most_i"))
        high = bands.select("token", F.col("tile").alias("j"), F.col("least").alias("least_j"))
        cells = (low.join(high, "token").filter(f"i <= j and {percent} * least_j <= 100 * most_i")
                 .select("token", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile")))
        signatures = texts.select(F.col("id").alias("a"), "signature")

        def across(cells, labels, forest):
            # the signatures, which are the bulk, are joined last and moved once
            rows = large.join(cells, ["token", "tile"])
            rows = rows.join(labels, "a", "left").withColumn("label", F.coalesce("label", "a")) if labels is not None else rows.withColumn("label", F.col("a"))
            return written(rows.join(signatures, "a").select("token", "i", "j", "tile", "a", "n", "pos", "signature", "label")
                           .repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
                           .mapInArrow(lambda batches: _tile_pairs(batches, forest, percent), "a long, b long, token long, i int, j int"))

        forest = across(cells, None, True)
        first = written(_verified(pairs.union(forest.filter("a is not null").select("a", "b")), texts, words, percent))
        left = forest.filter("a is null").select("token", "i", "j").distinct()
        rest = across(cells.join(left, ["token", "i", "j"], "left_semi"), components(first).select(F.col("id").alias("a"), "label"), False)
        links = first.union(_verified(rest.select("a", "b"), texts, words, percent))
    labels = components(written(links))
    named = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("label", "rep").alias("component_id"))
    grouped = measured.filter("n > 0").join(named, "digest", "left").select("id", "digest", "n", F.expr("if(id is null, null, component_id)").alias("c"))
    alone = measured.filter("n = 0").select("id", "digest", "n", F.col("id").alias("c"))
    return grouped.union(alone)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` without those that link, directly or over others, with a
    row of a smaller id; of rows with equal id and text one stays."""
    groups = written(_groups(df, id_col, text_col, words, percent))
    smaller = groups.filter("id <> c").select("id").distinct()
    dropped = _listed(smaller.select(F.col("id").alias(id_col)))
    kept = df.join(dropped, id_col, "left_anti").select(df.columns)
    # an id of several texts may lose one and keep another
    mixed = written(groups.filter("id = c").join(smaller, "id", "left_semi").select("id", "digest").distinct())
    if not mixed.isEmpty():
        both = df.join(_listed(mixed.select(F.col("id").alias(id_col)).distinct()), id_col, "left_semi").select(F.struct(*df.columns).alias("row"), F.col(text_col).alias("text"))
        both = _digested(both, words).join(mixed.withColumnRenamed("digest", "own"), (F.col(f"row.{id_col}") == F.col("id")) & F.col("digest").eqNullSafe(F.col("own")), "left_semi")
        kept = kept.unionByName(both.select("row.*"))
    again = written(groups.filter("id = c").groupBy("id").count().filter("count > 1").select(F.col("id").alias(id_col)))
    if again.isEmpty():
        return kept
    again = _listed(again)
    return (kept.join(again, id_col, "left_anti").select(df.columns)
            .unionByName(kept.join(again, id_col, "left_semi").select(df.columns).dropDuplicates([id_col, text_col])))
