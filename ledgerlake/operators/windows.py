"""Window, ranking, cumulative-share and top-k operators.

Global orderings (a Pareto over every product, a ROC over every score) would
run in a single task with ``Window.orderBy`` and no partition key.  The
operators here deal the rows by ranges of the whole sort key (value, tiebreaks and
a row number), so the pieces hold about equally many rows whatever the
distribution, and a value that most rows share is spread over many pieces.  The
window runs per piece in parallel; the sums of the pieces before are added from a table of
one row per piece, and so are the peers of a value that goes on in later pieces, so
RANGE-frame (peer-inclusive) semantics are exact.  Null values come last and keep their rows.

The input is written once to the shared folder, as its ranges are sampled first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialise

#: Buckets of a global ordering at least and at most.
LEAST_BUCKETS, MOST_BUCKETS = 64, 1000


def bucketed(df: DataFrame, value: str, descending: bool, out: str = "_bkt") -> DataFrame:
    """``df`` with the number of its value's bucket in the ordering, nulls last.
    The edges are approximate quantiles (within a tenth of a bucket)."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(MOST_BUCKETS, max(LEAST_BUCKETS, wanted))
    v = F.col(value).cast("double")
    # at most MOST_BUCKETS numbers, whatever the input
    edges = df.agg(F.percentile_approx(v, [k / n for k in range(1, n)], 20 * n)).first()[0] or []
    edges = F.array(*[F.lit(e) for e in sorted(set(edges))]).cast("array<double>")
    above = F.size(F.filter(edges, lambda e: e < v))
    return df.withColumn(out, F.when(v.isNull(), n).otherwise(n - 1 - above if descending else above))


def in_pieces(df: DataFrame, by: list[str], order: list[Column], sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows dealt by ranges of (``by``, ``order``): (rows, pieces).

    Rows: the columns of ``df``, ``_piece``, ``_row`` (from 1) and per column of ``sums`` ``_run_<col>``, the running sum
    in the piece (nulls count 0).  Pieces, one row each: ``_piece``, ``_before`` (rows) and ``_before_<col>``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = materialise(df.withColumn("_id", F.monotonically_increasing_id()))  # parts even rows that are equal throughout
    keys = [*(F.col(c).asc_nulls_first() for c in by), *order, F.col("_id")]
    w = Window.partitionBy("_piece").orderBy(*keys)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = (x.repartitionByRange(n, *keys).withColumn("_piece", F.spark_partition_id())
            .withColumns({"_row": F.row_number().over(w), **{f"_run_{c}": F.sum(F.coalesce(F.col(c), F.lit(0).cast(dict(x.dtypes)[c]))).over(run) for c in sums}}))
    rows = materialise(rows.drop("_id"))
    pieces = rows.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"), *[F.max_by(f"_run_{c}", "_row").alias(f"_s_{c}") for c in sums])
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per piece
    types = dict(rows.dtypes)
    pieces = pieces.select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).cast(types[f"_run_{c}"]).alias(f"_before_{c}") for c in sums])
    return rows, pieces


def peers_included(rows: DataFrame, pieces: DataFrame, value: str, sums: list[str]) -> DataFrame:
    """``rows`` of :func:`in_pieces` (without ``by``) with ``_rank`` and per column ``_cum_<col>``: the sum up to the last row
    of the row's value, wherever that stands, and ``_tot_<col>``."""
    rows = rows.join(F.broadcast(pieces), "_piece")
    rows = rows.withColumns({"_rank": (F.col("_row") + F.col("_before")).cast("long"), **{f"_run_{c}": F.col(f"_run_{c}") + F.col(f"_before_{c}") for c in sums}})
    # the value that a piece begins with may have begun before it, and its last piece knows the sum
    peers = Window.partitionBy("_piece", value)
    last = F.max(F.struct("_row", *[f"_run_{c}" for c in sums])).over(peers)
    rows = rows.withColumn("_last", last)
    ends = (rows.where("_row = 1").groupBy(F.col(value).alias("_value")).agg(F.max(F.struct("_piece", "_last")).alias("_e"))
            .select("_value", F.col("_e._last").alias("_later")))  # at most one row per piece
    rows = rows.join(F.broadcast(ends), rows[value].eqNullSafe(ends["_value"]), "left")
    return rows.withColumns({f"_cum_{c}": F.coalesce(F.col("_later")[f"_run_{c}"], F.col("_last")[f"_run_{c}"]) for c in sums}).drop("_later", "_last", "_value")


def ranked_running_total(df: DataFrame, value: str, tiebreak: list[str] | None = None,
                         descending: bool = True, rank_col: str = "_rank", cum_col: str = "_cum",
                         total_col: str = "_total") -> DataFrame:
    """Add a global row number (order by value, then ``tiebreak``), the
    running total over all rows ranking at or above the current value (peers
    included, like SQL's default RANGE frame) and the grand total.  Rows with a
    null value rank last; their running total is the total."""
    v = F.col(value)
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    rows, pieces = in_pieces(df, [], [order, *[F.col(c).asc() for c in tiebreak or []]], [value])
    total = rows.agg(F.sum(value).alias("_total"))  # one row
    out = peers_included(rows, pieces, value, [value]).withColumnsRenamed({"_rank": rank_col, f"_cum_{value}": cum_col})
    return out.crossJoin(F.broadcast(total)).withColumnRenamed("_total", total_col).select(*df.columns, rank_col, cum_col, total_col)


def cum_share(df: DataFrame, value: str, out: str = "cum_share", **kw) -> DataFrame:
    """Cumulative share of ``value`` in descending order (peers included)."""
    r = ranked_running_total(df, value, **kw)
    return (r.withColumn(out, F.col("_cum").cast("double") / F.col("_total").cast("double"))
             .drop("_cum", "_total"))


def rank_within(df: DataFrame, by: list[str], order: Column, out: str = "rank",
                method: str = "rank") -> DataFrame:
    """rank()/dense_rank()/row_number() per group (``RANKX`` with Skip = rank)."""
    fn = {"rank": F.rank, "dense": F.dense_rank, "row": F.row_number}[method]
    return df.withColumn(out, fn().over(Window.partitionBy(*by).orderBy(order)))


def top_n_ties(df: DataFrame, by: list[str], order_value: str, n: int,
               descending: bool = True) -> DataFrame:
    """TOPN(n) keeping ties: rows whose rank within ``by`` is <= n.

    With ``by`` empty the n-th best value is found with a distributed
    take-ordered (per-partition top-n, then merge) and used as a threshold,
    so no single task sorts the whole input."""
    v = F.col(order_value)
    if by:
        o = v.desc() if descending else v.asc()
        return (df.withColumn("_r", F.rank().over(Window.partitionBy(*by).orderBy(o)))
                  .filter(F.col("_r") <= n).drop("_r"))
    o = v.desc() if descending else v.asc()
    head = df.select(v.alias("_v")).orderBy(o).limit(n)
    thr = head.select((F.min("_v") if descending else F.max("_v"))).scalar()
    return df.filter(v >= thr) if descending else df.filter(v <= thr)


def lag_n(df: DataFrame, by: list[str], order: str, value: str, n: int, out: str) -> DataFrame:
    return df.withColumn(out, F.lag(value, n).over(Window.partitionBy(*by).orderBy(order)))


def first_diff(df: DataFrame, by: list[str], order: str, value: str, out: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn(out, F.col(value) - F.lag(value, 1).over(w))


def rolling_mean_prev(df: DataFrame, by: list[str], order: str, value: str, n: int,
                      out: str) -> DataFrame:
    """Mean of the previous n rows (current excluded), null until n exist."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-n, -1)
    return df.withColumn(out, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def running_sum(df: DataFrame, by: list[str], order: str, value: str, out: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def compound_index(df: DataFrame, by: list[str], order: str, factor: str, out: str) -> DataFrame:
    """Cumulative product of ``factor`` (positive) via exp(sum(ln))."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.exp(F.sum(F.log(F.col(factor))).over(w)))


def ffill_bfill(df: DataFrame, by: list[str], order: str, value: str, out: str) -> DataFrame:
    """Last non-null at or before the row, then back-fill the head."""
    wf = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    wb = Window.partitionBy(*by).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(wf),
                                         F.first(value, ignorenulls=True).over(wb)))


def ordered_cumsums(df: DataFrame, order: str, sums: list[str], descending: bool = True) -> DataFrame:
    """For each column in ``sums``: running total over all rows whose
    ``order`` value ranks at or ahead of the current one (peers included, nulls
    last), as ``_cum_<col>``, plus the grand total ``_tot_<col>``."""
    v = F.col(order)
    rows, pieces = in_pieces(df, [], [v.desc_nulls_last() if descending else v.asc_nulls_last()], sums)
    total = rows.agg(*[F.sum(c).alias(f"_tot_{c}") for c in sums])  # one row
    return (peers_included(rows, pieces, order, sums).crossJoin(F.broadcast(total))
            .select(*df.columns, *[f"_cum_{c}" for c in sums], *[f"_tot_{c}" for c in sums]))


def _of_group(df: DataFrame, by: list[str], order: list[Column], sums: list[str]) -> DataFrame:
    """Rows with ``_k`` (place in the group of ``by``, from 1), ``_in_<col>`` (running sum in the group), ``_n`` and ``_all_<col>`` (the
    group's): what the whole order counts up to the row, less what it counts up to the group's first."""
    rows, pieces = in_pieces(df, by, order, sums)
    rows = rows.join(F.broadcast(pieces), "_piece")
    rows = rows.withColumns({"_g": F.col("_row") + F.col("_before"), **{f"_run_{c}": F.col(f"_run_{c}") + F.col(f"_before_{c}") for c in sums}})
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(df.dtypes)[c])) for c in sums}
    groups = rows.groupBy(*by).agg(F.min("_g").alias("_g0"), F.count(F.lit(1)).alias("_n"),
                                   *[F.min_by(F.col(f"_run_{c}") - zero[c], "_g").alias(f"_s0_{c}") for c in sums], *[F.sum(c).alias(f"_all_{c}") for c in sums])
    keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in by]
    match = keys[0]
    for k in keys[1:]:
        match = match & k
    # groups of a third of the rows are split by the skew join, few groups are broadcast at run time
    out = rows.alias("r").join(groups.alias("g"), match).select("r.*", "_g0", "_n", *[f"_s0_{c}" for c in sums], *[f"_all_{c}" for c in sums])
    return out.withColumns({"_k": F.col("_g") - F.col("_g0") + 1, **{f"_in_{c}": F.col(f"_run_{c}") - F.col(f"_s0_{c}") for c in sums}})


def cum_share_rows(df: DataFrame, value: str, by: list[str], out: str = "cum_share") -> DataFrame:
    """Cumulative share of ``value`` within ``by``, one row at a time from the
    largest (peers not merged): the last row of a group has 1."""
    x = _of_group(df, by, [F.col(value).desc(), *[F.col(c) for c in df.columns if c not in (*by, value)]], [value])
    return x.withColumn(out, F.col(f"_in_{value}").cast("double") / F.col(f"_all_{value}").cast("double")).select(*df.columns, out)


def pct_rank_points(df: DataFrame, value: str, by: list[str], out: str = "pct_rank") -> DataFrame:
    """Position of each row in its group as a share of the rows: (rank - 0.5) / n."""
    return _of_group(df, by, [F.col(value).asc()], []).withColumn(out, (F.col("_k") - 0.5) / F.col("_n")).select(*df.columns, out)


def exact_quantiles(df: DataFrame, by: list[str], value: str, points: list[float]) -> DataFrame:
    """(by, q): linearly interpolated quantiles, exact, in two passes.  The first
    cuts every group at approximate quantiles and counts rows per bucket; the
    second sorts only the values of the buckets that hold a wanted position, so a
    group of any size never stands in one task."""
    n = 200
    x = df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    edges = x.groupBy(*by).agg(F.percentile_approx("_v", [k / n for k in range(1, n)], 20 * n).alias("_edges"))
    x = x.join(F.broadcast(edges), by).withColumn("_b", F.expr("size(filter(_edges, e -> e < _v))")).drop("_edges")
    counts = x.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_b")
    counts = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_total", F.sum("_n").over(Window.partitionBy(*by))))
    wanted = counts.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in points])))
    wanted = (wanted.withColumn("_pos", F.col("_p") * (F.col("_total") - 1))
              .withColumn("_k", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
              .filter("_k >= _before and _k < _before + _n"))
    rows = x.join(F.broadcast(wanted.select(*by, "_b", "_before").distinct()), [*by, "_b"])
    # a value that many rows share is one row with their number
    rows = rows.groupBy(*by, "_b", "_before", "_v").agg(F.count(F.lit(1)).alias("_m"))
    rows = rows.withColumn("_to", F.sum("_m").over(Window.partitionBy(*by, "_b").orderBy("_v")) + F.col("_before"))
    got = (rows.join(F.broadcast(wanted.select(*by, "_b", "_k", "_p", "_pos")), [*by, "_b"])
           .filter("_k >= _to - _m and _k < _to"))
    near = got.groupBy(*by, "_p", "_pos").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    value_at = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))
    return near.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_p", value_at.alias("q")))).alias("q"))
