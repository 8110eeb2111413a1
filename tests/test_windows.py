import random

import pandas as pd
from pyspark.sql import functions as F

from ledgerlake.operators.windows import (bucketed, cum_share_rows, exact_quantiles, ordered_cumsums, pct_rank_points,
                                          ranked_running_total, top_n_ties)


def test_ranked_running_total_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, float(rnd.choice([0, -3, 5, 5, 12.5, 100, 1e6, rnd.randint(-50, 5000)]))) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = ranked_running_total(df, "v", tiebreak=["k"]).toPandas().sort_values("_rank")
    pdf = pd.DataFrame(rows, columns=["k", "v"]).sort_values(["v", "k"], ascending=[False, True])
    pdf["rank"] = range(1, len(pdf) + 1)
    pdf["cum"] = pdf["v"].map(lambda x: pdf.loc[pdf.v >= x, "v"].sum())
    assert list(got["k"]) == list(pdf["k"])
    assert list(got["_rank"]) == list(pdf["rank"])
    assert all(abs(a - b) < 1e-6 for a, b in zip(got["_cum"], pdf["cum"]))
    assert abs(got["_total"].iloc[0] - pdf.v.sum()) < 1e-6


def test_ordered_cumsums_ascending(spark):
    rows = [(float(v), p) for v, p in [(1, 1), (2, 0), (2, 1), (3, 1), (10, 0)]]
    df = spark.createDataFrame(rows, "s double, p long")
    got = ordered_cumsums(df, "s", ["p"], descending=False).orderBy("s").collect()
    assert [r["_cum_p"] for r in got] == [1, 2, 2, 3, 3]
    assert all(r["_tot_p"] == 3 for r in got)


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 8.0), (4, 1.0)], "k int, v double")
    assert sorted(r.k for r in top_n_ties(df, [], "v", 1).collect()) == [1, 2]
    g = df.withColumn("g", F.lit("x"))
    assert sorted(r.k for r in top_n_ties(g, ["g"], "v", 2).collect()) == [1, 2]


def test_null_values_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (4, None), (5, 5.0)], "k int, v double")
    got = {r.k: (r["_rank"], r["_cum"]) for r in ranked_running_total(df, "v", tiebreak=["k"]).collect()}
    assert got == {3: (1, 7.0), 1: (2, 17.0), 5: (3, 17.0), 2: (4, 17.0), 4: (5, 17.0)}
    sums = {r.k: r["_cum_n"] for r in ordered_cumsums(df.withColumn("n", F.lit(1)), "v", ["n"]).collect()}
    assert sums == {3: 1, 1: 3, 5: 3, 2: 5, 4: 5}
    assert ranked_running_total(df.limit(0), "v").count() == 0
    assert [r["_rank"] for r in ranked_running_total(df.filter("v is null"), "v", tiebreak=["k"]).orderBy("k").collect()] == [1, 2]


def test_buckets_hold_at_most_twice_the_mean(spark):
    """Revenues over many magnitudes, and scores in [0, 1]."""
    rnd = random.Random(3)
    for draw in (lambda: 10 ** rnd.uniform(-2, 9), lambda: rnd.betavariate(8, 1)):
        df = spark.createDataFrame([(draw(),) for _ in range(20_000)], "v double")
        sizes = [r["count"] for r in bucketed(df, "v", True).groupBy("_bkt").count().collect()]
        assert len(sizes) > 50 and max(sizes) <= 2 * 20_000 / len(sizes)


def test_exact_quantiles(spark):
    rnd = random.Random(5)
    rows = [(g, rnd.choice([rnd.gauss(0, 1), 0.0, 1.5, None])) for g in "abc" for _ in range({"a": 3000, "b": 7, "c": 400}[g])] + [("d", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    pdf = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    points = [0.0, 0.01, 0.05, 0.5, 0.95, 1.0]
    for r in exact_quantiles(df, ["g"], "v", points).collect():
        want = pdf[pdf.g == r.g].v.quantile(points).to_dict()
        assert all(abs(r.q[p] - want[p]) < 1e-9 for p in points)


def test_row_shares_and_points(spark):
    df = spark.createDataFrame([("x", 1, 6.0), ("x", 2, 3.0), ("x", 3, 1.0), ("y", 4, 2.0)], "g string, k int, v double")
    assert [round(r.cum_share, 6) for r in cum_share_rows(df, "v", ["g"]).orderBy("k").collect()] == [0.6, 0.9, 1.0, 1.0]
    assert [r.pct_rank for r in pct_rank_points(df.filter("g = 'x'"), "v", ["g"]).orderBy("v").collect()] == [0.5 / 3, 1.5 / 3, 2.5 / 3]


def test_a_frequent_value_is_spread(spark):
    """Nine rows of ten share one value: ranks, totals and quantiles as ever, and no piece above twice the mean."""
    from ledgerlake.operators.windows import in_pieces
    rnd = random.Random(8)
    rows = [(i, 5.0 if rnd.random() < 0.9 else rnd.choice([None, rnd.uniform(-9, 9)])) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k long, v double")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    pieces, _ = in_pieces(df, [], [F.col("v").desc_nulls_last(), F.col("k")], ["v"])
    sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
    spark.conf.set("spark.sql.shuffle.partitions", was)
    assert len(sizes) >= 60 and max(sizes) <= 2 * 20_000 / len(sizes)
    got = ranked_running_total(df, "v", tiebreak=["k"]).toPandas().sort_values("_rank")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert list(got["k"]) == [k for k, _ in want] and list(got["_rank"]) == list(range(1, 20_001))
    total = {}
    run = 0.0
    for _, v in want:
        run += v or 0.0
        total[v] = run
    assert all(abs(c - total[v]) < 1e-6 for c, (_, v) in zip(got["_cum"], want))
    sums = ordered_cumsums(df.withColumn("n", F.lit(1)), "v", ["n"]).groupBy("v").agg(F.min("_cum_n").alias("a"), F.max("_cum_n").alias("b"), F.max("_tot_n").alias("t")).collect()
    place = {v: i + 1 for i, (_, v) in enumerate(want)}
    assert all(r.a == r.b == place[r.v] and r.t == 20_000 for r in sums)
    q = exact_quantiles(df.withColumn("g", F.lit(1)), ["g"], "v", [0.0, 0.04, 0.5, 0.97, 1.0]).first().q
    known = pd.Series([v for _, v in rows if v is not None])
    assert all(abs(q[p] - known.quantile(p)) < 1e-9 for p in q)


def test_equal_rows_and_groups_across_pieces(spark):
    """Rows equal throughout are dealt too; a group of most rows gets the shares of a plain loop."""
    rnd = random.Random(9)
    rows = [(None if rnd.random() < 0.01 else "big" if rnd.random() < 0.9 else rnd.choice("abc"), float(rnd.choice([1, 1, 1, 2, 7]))) for _ in range(5_000)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares, points = {}, {}
    for r in cum_share_rows(df, "v", ["g"]).collect():
        shares.setdefault(r.g, []).append((r.v, r.cum_share))
    for r in pct_rank_points(df, "v", ["g"]).collect():
        points.setdefault(r.g, []).append(r.pct_rank)
    for g in {g for g, _ in rows}:
        vs = sorted((v for h, v in rows if h == g), reverse=True)
        run = [sum(vs[:i + 1]) / sum(vs) for i in range(len(vs))]
        assert sorted(shares[g], key=lambda t: t[1]) == [(v, x) for v, x in zip(vs, run)]
        assert sorted(points[g]) == [(i + 0.5) / len(vs) for i in range(len(vs))]
