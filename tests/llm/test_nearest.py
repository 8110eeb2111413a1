import numpy as np
import pytest

from ledgerlake.llm import nearest as n

from .helpers import crowded


def brute(vectors, queries, k):
    out = []
    for q in sorted(queries):
        found = sorted(((-float((np.array(vectors[q]) * np.array(v)).sum()), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return out


def test_all_candidates_when_sure(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.standard_normal(6).round(1).tolist() for i in range(90)}
    for i in range(30, 70):
        vectors[i] = vectors[3]  # a hot vector, many ties
    vectors |= {200: [1.0, 2.0], 201: [2.0, 1.0], 202: [-1.0, 0.5]}  # another length
    odd = [(300, None), (301, [0.0] * 6), (302, [None] + [1.0] * 5), (303, [float("nan")] * 6), (304, [float("inf")] + [1.0] * 5), (305, []), (None, [1.0] * 6)]
    rows = [*vectors.items(), *odd, (3, vectors[3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = n.nearest(crowded(df), df.filter("vec_id % 20 = 0 or vec_id in (3, 33, 201, 300, 301)"), k=8, confidence=1 - 1e-12, block=25, chunk=3)
    expected = brute(vectors, [i for i in vectors if i % 20 == 0 or i in (3, 33, 201)], 8)
    got = sorted(map(tuple, got.collect()))
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected])


def test_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert n.nearest(df.limit(0), df).count() == 0 and n.nearest(df, df.limit(0)).count() == 0
    assert [(r.query_id, r.vec_id, r.rank) for r in n.nearest(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1)]


@pytest.mark.parametrize("table", ["sf0.01"])
def test_recall_on_the_table(spark, table):
    df = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    got = n.nearest(df, df.filter("vec_id % 20 = 0")).collect()
    expected = {(r[0], r[2]) for r in brute(vectors, [i for i in vectors if i % 20 == 0], 20)}
    assert len(got) == len(expected)
    assert len(expected & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(expected)


def test_chi_square_and_tree():
    assert n.chi_square(n.stop_radius(0.9, 16), 16) == pytest.approx(0.9)
    assert n.stop_radius(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    points = np.random.default_rng(0).standard_normal((1000, 4))
    tree = n.KdTree(points, 32)
    assert sorted(tree.order) == list(range(1000)) and (tree.end - tree.start).max() <= 32
    query = np.ones(4)
    true = ((points[tree.order] - query) ** 2).sum(axis=1)
    for bound, a, b in zip(tree.bounds(query), tree.start, tree.end, strict=True):
        assert bound <= true[a:b].min() + 1e-12
