"""Exact splits, champion, cross-fitted effects, casts with rejects, allocation without loss."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import etl as E
from ledgerlake.plans import causal as C
from ledgerlake.plans import risk as R


def plain_test_ids(ids, fraction, seed):
    n = int(len(ids) * fraction + 0.5)
    return set(sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15])[:n])


@pytest.mark.parametrize("sizes", [(1000, 37), (3, 1), (20_000, 2), (0, 5)])
def test_split_is_exact_per_label(spark, sizes):
    rows, at = [], 0
    for label, n in enumerate(sizes):
        rows += [(i, label) for i in range(at, at + n)]
        at += n
    df = spark.createDataFrame(rows, "doc_id long, label int")
    got = R.split_by_label(df, "label", "doc_id", 0.25, "7").where("en_prueba").collect()
    for label in range(2):
        ids = [i for i, y in rows if y == label]
        assert {r.doc_id for r in got if r.label == label} == plain_test_ids(ids, 0.25, "7")
        assert abs(sum(r.label == label for r in got) - 0.25 * len(ids)) <= 1


def test_split_small_steps_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(R, "STEP_BITS", 4)
    df = spark.createDataFrame([(k % 50, 0) for k in range(500)] + [(None, 0), (9, None)], "doc_id long, label int")
    got = R.split_by_label(df, "label", "doc_id", 0.3, "x").groupBy("doc_id", "label").agg(F.collect_set("en_prueba").alias("s")).collect()
    assert all(len(r.s) == 1 for r in got) and not any(r.s[0] for r in got if r.doc_id is None)
    # rows with one id stay together, so the cut rounds to whole ids
    assert sum(10 for r in got if r.s[0]) == 150


def test_champion_ties_go_to_the_first(spark):
    m = spark.createDataFrame([("b", 0.8), ("a", 0.8), ("c", 0.7)], "Modelo string, AUC_ROC double")
    for order, best in ((["a", "b", "c"], "a"), (["b", "a", "c"], "b"), (["c", "b", "a"], "b")):
        assert [r.Modelo for r in R.champion_select(m, order).where("EsCampeon").collect()] == [best]


def test_credit_scoring_separates(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(["en", "de"]), "s", int(k % 3 == 0), int(k % 2), float(1000 + 900 * (k % 2) + rng.randrange(300))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, toxic int, label int, score double")
    metrics, scored = R.credit_scoring(df)
    got = metrics.collect()
    assert len(got) == 3 and all(r.AUC_ROC > 0.99 for r in got) and sum(r.EsCampeon for r in got) == 1
    assert {n: p.count() for n, p in scored.items()} == dict.fromkeys([r.Modelo for r in got], 100)


def planted(spark, n=4000, effect=1.85):
    """Discount and volume both depend on the channel and the month; the effect is known."""
    rng = random.Random(1)
    rows = []
    for k in range(n):
        channel, month = rng.randrange(4), rng.randrange(12)
        pull = 0.05 * channel + 0.03 * math.sin(2 * math.pi * month / 12)
        d = pull + rng.gauss(0.1, 0.03)
        rows.append((k, f"c{channel}", month, float(channel), math.sin(2 * math.pi * month / 12), d, 4.5 + effect * d + 6 * pull + rng.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "id long, channel string, month int, x1 double, x2 double, D double, Y double")
    return df.withColumn("fold", F.expr(C.fold_sql("id")))


def test_cross_fitted_cells_find_the_effect(spark):
    r = C.cross_fitted_cells(planted(spark), ["channel", "month"]).first()
    assert r.IC_95_Inferior < 1.85 < r.IC_95_Superior and r.Significativo_P05 and r.Benchmark_OLS_Ingenuo > 3


def test_cross_fitted_cells_plain(spark):
    """Row by row, with cells that stand in one fold only, and null treatments."""
    rng = random.Random(2)
    rows = [(rng.choice("ab"), f"m{k if k < 5 else k % 3}", rng.randrange(3), rng.choice([None, 1.0, 2.0, 3.5]), rng.uniform(0, 4)) for k in range(60)]
    got = C.cross_fitted_cells(spark.createDataFrame(rows, "a string, b string, fold int, D double, Y double"), ["a", "b"]).first()
    rows = [r for r in rows if r[3] is not None]

    def mean(v):
        return sum(v) / len(v)

    res = []
    for a, b, f, d, y in rows:
        near = [r for r in rows if r[:2] == (a, b) and r[2] != f] or [r for r in rows if r[2] != f]
        res.append((d - mean([r[3] for r in near]), y - mean([r[4] for r in near])))
    theta = sum(x * y for x, y in res) / sum(x * x for x, _ in res)
    se = math.sqrt(mean([(y - theta * x) ** 2 for x, y in res]) / sum(x * x for x, _ in res))
    assert got.CoeficienteEstimado == pytest.approx(theta, abs=1e-7) and got.ErrorEstandar == pytest.approx(se, abs=1e-7) and got.n == len(rows)


def test_cross_fitted_models_find_the_effect(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    df = VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(planted(spark, 1500))
    r = C.cross_fitted(df, "features", lambda label: GBTRegressor(maxIter=15, maxDepth=3, seed=1), folds=3).first()
    assert abs(r.CoeficienteEstimado - 1.85) < 0.3 and r.SesgoEliminadoPct > 40 and r.n == df.where("fold < 3").count()


def test_cast_columns(spark):
    df = spark.createDataFrame([("1", "2020-01-31", " 7 ", "keep"), ("x", "2020-02-30", None, "k2"), ("x", "31/01/2020", "9,5", None), (None, "2020-1-1", "1e3", "")],
                               "a string, b string, c string, d string")
    typed, rejects = E.cast_columns(df, {"a": "int", "b": ("date", r"\d{4}-\d{2}-\d{2}"), "c": "double"})
    assert typed.dtypes == [("a", "int"), ("b", "date"), ("c", "double"), ("d", "string")]
    want = [(1, "2020-01-31", 7.0, "keep"), (None, None, None, "k2"), (None, None, None, None), (None, None, 1000.0, "")]
    assert sorted([(r.a, r.b and str(r.b), r.c, r.d) for r in typed.collect()], key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, rejects.collect())) == [("a", "x", 2), ("b", "2020-02-30", 1), ("b", "2020-1-1", 1), ("b", "31/01/2020", 1), ("c", "9,5", 1)]
    assert E.cast_columns(df.limit(0), {"a": "int"})[1].collect() == []


def test_allocation_keeps_amounts_without_weights(spark):
    amounts = spark.createDataFrame([("x", 10.0), ("y", 5.0)], "k string, amount double")
    weights = spark.createDataFrame([("x", "m1", 0.333), ("x", "m2", 0.667), ("z", "m1", 1.0)], "k string, member string, w double")
    got = sorted(((r.k, r.member, float(r.asignado)) for r in E.allocate_exact(amounts, weights, ["k"], "member", "amount", "w").collect()), key=repr)
    assert got == [("x", "m1", 3.33), ("x", "m2", 6.67), ("y", None, 5.0)]
