"""Mixing sources to target weights, by DataFrame functions only.

1. *Targets*: sources share the words of the corpus by weight; a source that would
   be repeated more than ``cap`` times stops there and the others share its excess.
2. *Stream*: the documents of a source, in an order given by a hash, ``cap`` times one
   after the other.  The source gives the longest beginning within its target, then of
   the next ``FILL`` documents each that still fits; or the document behind the
   beginning, where that ends nearer to the target.
3. *Quotas*: each stream is cut into blocks of equal words.  A tree splits the output
   shards in halves; at each node the blocks of all sources are divided by one draw
   from the multivariate hypergeometric distribution, so every quota and every
   shard's number of blocks is kept exactly and no draw depends on another branch.
   Sources are drawn in two steps, chunks of them and then the sources of a chunk, so that no row
   holds more than about the square root of their number.
4. *Shards*: a shard takes its blocks from the disjoint run that the tree gave it of each
   (permuted) stream and orders its documents by a hash.

No step puts the documents of a source into one task: orders are cut by hash into
buckets, and sums before a bucket come from a table of buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Words of a block, and blocks of a shard.
BLOCK_WORDS, SHARD_BLOCKS = 1_024, 4_096
#: Documents behind the beginning that may fill what is left to the target.
FILL = 512
#: Documents of a bucket of the hash order, about; buckets in a window.
BUCKET, FAN = 4_096, 1_024
#: A document is taken so many times at most.
CAP = 3
_WHITE = r"[\x20\x09-\x0D]+"
#: Bits of the hash that orders documents.
_HASH_BITS = 60


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; null has none."""
    parts = F.split(text, _WHITE)
    # white space at either end leaves an empty part there
    ends = [F.when(F.element_at(parts, k) == "", 1).otherwise(0) for k in (1, -1)]
    inner = F.size(parts) - ends[0] - ends[1]
    return F.when(text.isNull() | (text == ""), 0).otherwise(F.greatest(inner, F.lit(0))).cast("long")


def _key(source: Column) -> Column:
    """Text that sorts sources by code point with null last, and is never null."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string")))


def units(docs: DataFrame, seed: str) -> DataFrame:
    """One row per document: doc_id, source, key, size, digest, copy, uid, place.
    Equal rows get numbers (``copy``), so each has its own place in the order."""
    seen = docs.select("doc_id", "source", _key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"))
    rows = (seen.groupBy("doc_id", "source", "key", "size", "digest").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n"))
    uid = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "key", "digest", F.col("copy").cast("string")))
    return (rows.withColumn("uid", uid)
            .withColumn("place", F.conv(F.substring("uid", 1, _HASH_BITS // 4), 16, 10).cast("long")))


def running(df: DataFrame, place: str, values: list[str], most: int) -> DataFrame:
    """``df`` (one row per key and place below ``most``) with ``before_<value>``, the sums over the
    smaller places of its key.  Windows hold at most FAN places; sums before a window come
    from the same function on the windows' sums."""
    up, window = most > FAN, f"{place}_up"
    group = ["key", window] if up else ["key"]
    rows = df.withColumn(window, F.floor(F.col(place) / FAN)) if up else df
    before = Window.partitionBy(*group).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(before), F.lit(0)) for v in values})
    if not up:
        return out
    above = running(rows.groupBy(*group).agg(*(F.sum(v).alias(v) for v in values)), window, values, -(-most // FAN))
    above = above.select(*group, *(F.col(f"before_{v}").alias(f"_{v}") for v in values))
    return (out.join(above, group).withColumns({f"before_{v}": F.col(f"before_{v}") + F.col(f"_{v}") for v in values})
            .select(*df.columns, *(f"before_{v}" for v in values)))


def numbered(keys: DataFrame) -> DataFrame:
    """Distinct keys with ``rank``, their number from 0 in the order of ``key``."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(keys.repartitionByRange(n, "key").sortWithinPartitions("key")
                   .withColumn("_id", F.monotonically_increasing_id())
                   .withColumn("_part", F.shiftright("_id", 33)).withColumn("_row", F.col("_id").bitwiseAND((1 << 33) - 1)))
    # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(parts), "_part").withColumn("rank", F.col("_before") + F.col("_row")).drop("_part", "_row", "_before", "_id")


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """``sources`` (key, source_size, weight) with ``target``, in words: all sizes shared by weight,
    none above ``cap`` times its size, the excess shared by the others in turn."""
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight, capped = int(total or 0), int(weights or 0), -1
    full = sources.withColumn("_full", (F.col("source_size") * cap).cast("decimal(38,0)"))
    left, share = words, weight
    while True:
        # a source is full if its cap lies below its part of what is left
        below = F.col("_full") * F.lit(str(share)).cast("decimal(18,0)") < F.col("weight").cast("decimal(18,0)") * F.lit(str(left)).cast("decimal(19,0)")
        at = full.where(below).agg(F.count(F.lit(1)), F.sum("_full"), F.sum("weight")).first()
        if at[0] == capped or share == 0:
            break
        capped, left, share = at[0], words - int(at[1] or 0), weight - int(at[2] or 0)
    free = F.lit(left).cast("long") * F.col("weight")
    return (full.withColumn("target", F.when(below, F.col("_full").cast("double"))
                            .otherwise(free.cast("double") / F.lit(float(max(share, 1))))).drop("_full"))


def allocate(docs: DataFrame, weights: tuple[int, ...], cap: int = CAP, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """What the mix takes: (documents, sources).

    Documents: the columns of :func:`units`, source_size, target, ``copies`` taken and ``starts``, the
    places in the source's stream (in words) where these begin.  Sources: key, rank, words taken.
    The weights are given to the sources in code point order, null last, and repeat.
    """
    every = written(units(docs, seed))
    count = every.count()
    bits = max(0, math.ceil(math.log2(max(1, count / BUCKET))))
    most = 1 << bits
    bucket = F.shiftright("place", _HASH_BITS - bits)
    stream = every.where("size > 0").withColumn("bucket", bucket)

    sizes = every.groupBy("key").agg(F.sum("size").alias("source_size"), F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("source_n"))
    rank = numbered(sizes)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(targets(rank.withColumn("weight", weight.cast("long")), cap))

    # the buckets of each source: words and documents before them, and those near the end of the beginning
    buckets = running(stream.groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")),
                      "bucket", ["words", "n"], most).join(sources, "key")
    rest = F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")
    buckets = written(buckets.withColumn("_end", (F.col("before_words") <= rest) & (rest < F.col("before_words") + F.col("words"))))
    ends = buckets.where("_end").select("key", F.col("before_n").alias("_at"), F.col("n").alias("_n"))
    after = (F.col("before_n") - F.col("_at") + F.col("source_n")) % F.col("source_n")
    buckets = (buckets.join(ends, "key", "left").withColumn("near", F.coalesce(after <= F.col("_n") + FILL, F.lit(False)))
               .select("key", "bucket", "before_words", "before_n", "source_size", "source_n", "target", "rank", "near"))

    before = Window.partitionBy("key", "bucket").orderBy("uid")
    start = F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (stream.withColumns({"_start": start, "_pos": F.row_number().over(before) - 1}).join(buckets, ["key", "bucket"])
              .withColumns({"start": F.col("before_words") + F.col("_start"), "pos": F.col("before_n") + F.col("_pos")}))
    begins = [F.col("start") + k * F.col("source_size") for k in range(cap)]
    copies = sum((F.when(b + F.col("size") <= F.col("target"), 1).otherwise(0) for b in begins[1:]), F.when(begins[0] + F.col("size") <= F.col("target"), 1).otherwise(0))
    placed = written(placed.withColumn("copies", copies).withColumn("next", F.col("copies") * F.col("source_n") + F.col("pos"))
                     .drop("_start", "_pos", "before_words", "before_n", "bucket"))
    extra = _fill(placed.where("near"), cap)

    begun = F.filter(F.array(*[F.when(F.col("copies") > k, b) for k, b in enumerate(begins)]), lambda b: b.isNotNull())
    done = placed.withColumn("starts", begun)
    near = done.where("near").join(extra, ["key", "next"], "left")
    near = near.withColumn("starts", F.when(F.col("_offset").isNull(), F.col("starts")).otherwise(F.array_append("starts", F.col("_offset")))).drop("_offset")
    columns = ["uid", "doc_id", "source", "key", "rank", "size", "digest", "source_size", "target", "starts"]
    wordless = (every.where("size = 0").join(sources, "key")
                .withColumn("starts", F.array().cast("array<long>")).select(columns))
    taken = done.where("NOT near").select(columns).unionByName(near.select(columns)).unionByName(wordless)
    taken = written(taken.withColumn("copies", F.size("starts")))
    per_source = taken.groupBy("key", "rank").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    return taken, per_source


def _fill(near: DataFrame, cap: int) -> DataFrame:
    """(key, next, _offset) of the documents that fill what the beginning of each source leaves to its target."""
    place = Window.partitionBy("key").orderBy("next")
    # at most FILL + 1 rows a source, out of the few buckets next to the end
    rows = (near.where(F.col("copies") < cap).withColumn("_k", F.row_number().over(place)).where(F.col("_k") <= FILL + 1)
            .withColumn("_begin", F.col("start") + F.col("copies") * F.col("source_size")))
    lists = rows.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("next", "size", "_begin", "target"))).alias("rows"))
    first = F.element_at("rows", 1)
    gap = first["target"] - first["_begin"]
    nothing = F.array().cast("array<struct<next:bigint,offset:bigint>>")

    def step(state: Column, row: Column) -> Column:
        fits = row["size"] <= gap - state["filled"]
        here = F.struct(row["next"].cast("long").alias("next"), (first["_begin"] + state["filled"]).cast("long").alias("offset"))
        return F.struct(F.when(fits, state["filled"] + row["size"]).otherwise(state["filled"]).alias("filled"),
                        F.when(fits, F.array_append(state["picked"], here)).otherwise(state["picked"]).alias("picked"))

    filled = F.aggregate(F.slice("rows", 2, FILL), F.struct(F.lit(0).cast("long").alias("filled"), nothing.alias("picked")), step)
    whole = F.array(F.struct(first["next"].cast("long").alias("next"), first["_begin"].cast("long").alias("offset")))
    picked = F.when(first["size"] - gap < gap - F.col("f")["filled"], whole).otherwise(F.col("f")["picked"])
    return (lists.withColumn("f", filled).select("key", F.explode(picked).alias("p"))
            .select("key", F.col("p")["next"].alias("next"), F.col("p")["offset"].alias("_offset")))


# --- the splitting tree ----------------------------------------------------------------------

def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def log_factorial(n: Column) -> Column:
    """Natural logarithm of n!, by table below 16 and by Stirling's series above."""
    table = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(16)])
    x = F.greatest(n, F.lit(16)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 16, F.element_at(table, F.least(n, F.lit(15)).cast("int") + 1)).otherwise(series)


def _uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double") * F.lit(2.0 ** -53)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` without replacement are among ``good`` (of good + bad): the uniform
    number is used up from the likeliest outcome outwards (exact up to rounding of the
    probabilities; the outcome always lies in the possible range)."""
    low, high = F.greatest(F.lit(0), draws - bad), F.least(draws, good)
    total = good + bad
    mode = F.greatest(low, F.least(high, F.floor((draws + 1).cast("double") * (good + 1) / (total + 2)).cast("long")))

    def log_choose(n: Column, k: Column) -> Column:
        return log_factorial(n) - log_factorial(k) - log_factorial(n - k)

    def walk(m: Column) -> Column:
        p = F.exp(log_choose(good, m) + log_choose(bad, draws - m) - log_choose(total, draws))
        g, b, d, t = (c.cast("double") for c in (good, bad, draws, total))
        deviation = F.sqrt(d * (g / t) * (b / t) * (t - d) / F.greatest(t - 1, F.lit(1.0)))
        # beyond 12 deviations less is left than a double's last digit
        reach = F.least(F.greatest(high - m, m - low), F.ceil(12 * deviation) + 20)

        def outwards(s: Column, _: Column) -> Column:
            up = s["up"] * (g - s["x"]) * (d - s["x"]) / ((s["x"] + 1) * (b - d + s["x"] + 1))
            down = s["down"] * s["y"] * (b - d + s["y"]) / ((g - s["y"] + 1) * (d - s["y"] + 1))
            up = F.when(s["x"] < high, up).otherwise(0.0)
            down = F.when(s["y"] > low, down).otherwise(0.0)
            new = F.struct(up.alias("up"), down.alias("down"))
            return F.when(s["found"].isNotNull(), s).otherwise(_let(new, lambda n: F.struct(
                (s["left"] - n["up"] - n["down"]).alias("left"), n["up"].alias("up"), n["down"].alias("down"),
                (s["x"] + 1).alias("x"), (s["y"] - 1).alias("y"),
                F.when(s["left"] < n["up"], (s["x"] + 1).cast("long")).when(s["left"] < n["up"] + n["down"], (s["y"] - 1).cast("long")).alias("found"))))

        begin = F.struct((u - p).alias("left"), p.alias("up"), p.alias("down"), m.cast("double").alias("x"), m.cast("double").alias("y"),
                         F.when(u < p, m).alias("found"))
        steps = F.when(reach > 0, F.sequence(F.lit(1).cast("long"), reach.cast("long"))).otherwise(F.array().cast("array<long>"))
        return F.coalesce(F.aggregate(steps, begin, outwards)["found"], m)

    return F.when(low == high, low).otherwise(_let(mode, walk)).cast("long")


def multivariate(cells: Column, draws: Column, uniform: Callable[[Column], Column]) -> Column:
    """One multivariate hypergeometric draw: for ``cells`` (array of struct with id and n) how many of
    ``draws`` fall to each, as an array in the same order."""
    total = F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + c["n"])

    def step(s: Column, c: Column) -> Column:
        took = hypergeometric(c["n"], s["rest"] - c["n"], s["draws"], uniform(c["id"]))
        return _let(took, lambda x: F.struct((s["rest"] - c["n"]).alias("rest"), (s["draws"] - x).alias("draws"), F.array_append(s["out"], x).alias("out")))

    begin = F.struct(total.alias("rest"), draws.cast("long").alias("draws"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(cells, begin, step)["out"]


def split_quotas(quotas: DataFrame, shards: int, seed: str = "") -> DataFrame:
    """Divide exact quotas among shards of (almost) equal numbers of blocks.

    ``quotas``: id (numbers from 0) and n.  Result: shard, id, start, n: the shard takes the
    blocks ``start`` to ``start + n - 1`` of that id.  Every id's quota and every shard's number of blocks is
    met exactly; shards that share blocks by chance alone would have this distribution.
    """
    held, count = quotas.agg(F.sum("n"), F.max("id")).first()
    blocks, count = int(held or 0), int(count or 0) + 1
    chunk = max(1, math.isqrt(count))
    cell = F.struct(F.col("id").cast("long").alias("id"), F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("n"))
    tree = (quotas.where("n > 0").groupBy(F.floor(F.col("id") / chunk).alias("chunk")).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
            .select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "chunk", "cells"))

    def first_block(shard: Column) -> Column:
        return F.floor(shard.cast("decimal(20,0)") * F.lit(blocks).cast("decimal(18,0)") / F.lit(shards).cast("decimal(18,0)")).cast("long")

    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        tree = written(tree)
        nodes = tree.where("hi - lo > 1").withColumn("mid", F.floor((F.col("lo") + F.col("hi") + 1) / 2))
        n = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c["n"])
        # one row per node, about the square root of the number of ids in each
        totals = nodes.groupBy("lo", "mid").agg(F.sort_array(F.collect_list(F.struct(F.col("chunk").alias("id"), n.alias("n")))).alias("chunks"))
        draws = first_block(F.col("mid")) - first_block(F.col("lo"))
        left = multivariate(F.col("chunks"), draws, lambda c: _uniform(seed, F.lit(0), F.col("lo"), F.col("mid"), c))
        per_chunk = totals.select("lo", F.explode(F.arrays_zip(F.col("chunks")["id"].alias("chunk"), left.alias("draws"))).alias("z")).select("lo", "z.chunk", "z.draws")
        drawn = (nodes.join(per_chunk, ["lo", "chunk"])
                 .withColumn("left", multivariate(F.col("cells"), F.col("draws"), lambda c: _uniform(seed, F.lit(1), F.col("lo"), F.col("mid"), c))))

        def half(side: int) -> Column:
            def of(c: Column, x: Column) -> Column:
                taken = [x, c["n"] - x][side]
                return F.struct(c["id"].alias("id"), (c["start"] + x if side else c["start"]).alias("start"), taken.alias("n"))
            low, high = [("lo", "mid"), ("mid", "hi")][side]
            return F.struct(F.col(low).alias("lo"), F.col(high).alias("hi"), "chunk",
                            F.filter(F.zip_with("cells", "left", of), lambda c: c["n"] > 0).alias("cells"))

        halves = drawn.select(F.explode(F.array(half(0), half(1))).alias("h")).select("h.*").where(F.size("cells") > 0)
        tree = tree.where("hi - lo <= 1").unionByName(halves)
    return tree.select(F.col("lo").alias("shard"), F.explode("cells").alias("c")).select("shard", "c.id", "c.start", "c.n")


def mix(docs: DataFrame, weights: tuple[int, ...], cap: int = CAP, seed: str = "", block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (doc_id, text, source): (documents, shards).

    Documents are the rows of :func:`allocate`, one per row of ``docs``.  Shards: shard, position
    (from 1), uid, doc_id, source, digest (MD5 of the text), size; a document appears as often as it
    is taken.  The result depends on the rows and the seed only, not on their order or partitions.

    Null ids and sources are values of their own (a null source comes last); a null text is an empty
    one; documents without words are never taken; equal rows are documents each; an empty table
    gives empty results; other columns take no part.
    """
    taken, per_source = allocate(docs, weights, cap, seed)
    copies = taken.select("*", F.explode("starts").alias("_start")).withColumn("block", F.floor(F.col("_start") / block_words))
    quotas = written(per_source.select(F.col("rank").alias("id"), F.ceil(F.col("words") / block_words).alias("n")))
    blocks = quotas.agg(F.sum("n")).first()[0] or 0
    leaves = split_quotas(quotas, max(1, -(-int(blocks) // shard_blocks)), seed)
    owner = leaves.select("shard", F.col("id").alias("rank"), F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("block"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "uid", "_start"), "uid", "_start")
    shards = (copies.join(owner, ["rank", "block"]).withColumn("position", F.row_number().over(order))
              .select("shard", "position", "uid", "doc_id", "source", "digest", "size"))
    return taken, shards


def texts(shards: DataFrame, docs: DataFrame) -> DataFrame:
    """The shards with their documents' texts, to be written (for example partitioned by shard)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    distinct = docs.select(text.alias("text")).groupBy(F.md5("text").alias("digest")).agg(F.first("text").alias("text"))
    return shards.join(distinct, "digest").select("shard", "position", "doc_id", "source", "text")
