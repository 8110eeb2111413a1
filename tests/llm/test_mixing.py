"""Mixing against its SQL on odd tables, exact margins of the tree, and its draws' distribution."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing
from ledgerlake.llm.queries import MIX_WEIGHTS, ORACLES

from .helpers import crowded

SCHEMA = "doc_id long, text string, source string"


def by_sql(rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64", "text": object, "source": object})
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM frame")
    return sorted(con.execute(ORACLES["op11_mixing"]).fetchall(), key=repr)


def taken_of(df):
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r["size"] * r.copies) for r in df.collect()), key=repr)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(n)]), rng.choice([None, "", " \x0b\n", "one", " two  words\t"] + [" ".join(["w"] * rng.randrange(1, 400))] * 9),
             rng.choice(sources)) for _ in range(n)]
    return rows + rows[:20]


@pytest.mark.parametrize("sources", [["a"] * 20 + ["", "b", "Z", "é", None], [None], ["a", "b"]])
def test_against_sql(spark, sources):
    rows = corpus(len(sources), 300, sources)
    taken, shards = mixing.mix(crowded(spark.createDataFrame(rows, SCHEMA)), MIX_WEIGHTS, seed="11", block_words=64, shard_blocks=16)
    assert taken_of(taken) == by_sql(rows)
    # every copy lies in one shard, and shards are numbered through
    drawn = shards.groupBy("uid").count().join(taken, "uid", "full").where("coalesce(count, 0) <> coalesce(copies, 0)")
    assert drawn.count() == 0
    for r in shards.groupBy("shard").agg(F.max("position").alias("m"), F.count("*").alias("n"), F.countDistinct("position").alias("d")).collect():
        assert r.m == r.n == r.d


def test_small_buckets(spark, monkeypatch):
    """Several levels of buckets give what one gives."""
    rows = corpus(5, 600, ["hot"] * 9 + ["x", None])
    monkeypatch.setattr(mixing, "BUCKET", 4)
    monkeypatch.setattr(mixing, "FAN", 4)
    taken, _ = mixing.allocate(spark.createDataFrame(rows, SCHEMA), MIX_WEIGHTS, seed="11")
    assert taken_of(taken) == by_sql(rows)


def test_reruns_and_partitions(spark):
    rows = corpus(7, 200, ["a", "a", "b", "c"])
    first, second = (sorted(map(tuple, mixing.mix(df, MIX_WEIGHTS, seed="s", block_words=32, shard_blocks=8)[1].collect()), key=repr)
                     for df in (spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1)))
    assert first == second


def test_long_document_and_texts(spark):
    rows = [(1, "w " * 50_000, "a"), (2, "x " * 10, "a"), (3, "y y", "b"), (4, "z", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    taken, shards = mixing.mix(df, (1, 1), seed="t")
    copies = {r.doc_id: r.copies for r in taken.collect()}
    assert copies == {1: 1, 2: 0, 3: 3, 4: 3} or copies[1] == 1 and copies[3] == copies[4] == 3
    got = sorted((r.doc_id, r.text) for r in mixing.texts(shards, df).collect())
    assert got == sorted((i, t) for i, t, _ in rows for _ in range(copies[i]))


def test_empty(spark):
    for rows in ([], [(1, None, None), (2, "", "a")]):
        taken, shards = mixing.mix(spark.createDataFrame(rows, SCHEMA), MIX_WEIGHTS)
        assert shards.collect() == [] and sorted(r.copies for r in taken.collect()) == [0] * len(rows)


def test_targets(spark):
    sizes = [1, 10, 100, 1000, 50, 0, 7]
    df = spark.createDataFrame([(str(k), s, (5, 2, 1)[k % 3]) for k, s in enumerate(sizes)], "key string, source_size long, weight long")
    got = {r.key: r.target for r in mixing.targets(df).collect()}
    assert sum(got.values()) == pytest.approx(sum(sizes))
    free = {k: t for k, t in got.items() if t < 3 * sizes[int(k)]}
    shares = {round(t / (5, 2, 1)[int(k) % 3], 6) for k, t in free.items()}
    assert len(shares) == 1 and all(t == 3 * sizes[int(k)] for k, t in got.items() if k not in free)
    assert all(3 * sizes[int(k)] <= max(shares) * (5, 2, 1)[int(k) % 3] for k in got if k not in free)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", " a  b\t\n", "a\xa0b", "\x0b\x0c", "a\x00b c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", mixing.word_count(F.col("t")).alias("n"))
    assert all(r.n == len((r.t or "").encode().split()) for r in df.collect())


def test_tree_keeps_margins(spark):
    quotas = [(k, n) for k, n in enumerate([500, 0, 3, 40, 1, 1, 77] + [2] * 60)]
    total = sum(n for _, n in quotas)
    leaves = mixing.split_quotas(spark.createDataFrame(quotas, "id long, n long"), 11, "x").collect()
    for k, n in quotas:
        runs = sorted((r.start, r.n) for r in leaves if r.id == k)
        assert [s for s, _ in runs] == [sum(m for _, m in runs[:j]) for j in range(len(runs))] and sum(m for _, m in runs) == n
    per_shard = [sum(r.n for r in leaves if r.shard == s) for s in range(11)]
    assert per_shard == [(s + 1) * total // 11 - s * total // 11 for s in range(11)]
    assert len(leaves) == len({(r.shard, r.id) for r in leaves})


@pytest.mark.parametrize("good,bad,draws", [(30, 70, 20), (3, 2, 4), (1, 0, 1), (2000, 500, 1200), (40, 4, 40)])
def test_hypergeometric(spark, good, bad, draws):
    n = 8_000
    g, b, d = (F.lit(v).cast("long") for v in (good, bad, draws))
    u = mixing._uniform("seed", F.col("id"))
    got = np.array([r[0] for r in spark.range(n).select(mixing.hypergeometric(g + F.col("id") * 0, b, d, u)).collect()])
    assert got.min() >= max(0, draws - bad) and got.max() <= min(draws, good)
    mean, total = draws * good / (good + bad), good + bad
    var = mean * (bad / total) * (total - draws) / max(1, total - 1)
    assert abs(got.mean() - mean) <= 4 * (var / n) ** 0.5 + 1e-9 and abs(got.var() - var) <= 6 * var * (2 / n) ** 0.5 + 1e-9


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(corpus(1, 50, ["a", "b"]), SCHEMA)
    taken, shards = mixing.mix(df, MIX_WEIGHTS)
    for part in (taken, shards):
        assert "Python" not in part._jdf.queryExecution().toString() and "Arrow" not in part._jdf.queryExecution().toString()
