import zlib

import numpy as np

from ledgerlake.llm import quality as q

from .helpers import crowded, documents


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    good = label.sum()
    return (rank[label == 1].sum() - good * (good + 1) / 2) / (good * (len(label) - good))


def test_held_out_accuracy(spark):
    """Labels that were never learnt from, on the given table."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    known = dict(labels.select("doc_id", "quality").collect())
    rows = [r for r in q.classify(docs, labels).collect() if r.doc_id in known and r.held_out]
    score, label = np.array([r.score for r in rows]), np.array([known[r.doc_id] for r in rows])
    assert len(rows) > 500 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert auc(score, label) > 0.99
    assert ((score >= 0.3) == label).mean() > 0.97
    bins = np.digitize(score, [0.1, 0.5, 0.9])  # probabilities mean what they say
    assert abs(score.mean() - label.mean()) < 0.03 and label[bins == 0].mean() < 0.2 and label[bins == 3].mean() > 0.9


def small(spark):
    good = [" ".join(f"word{k % 37} and{(k * i) % 11}" for k in range(30)) for i in range(60)]
    bad = [" ".join(f"BUY{k % 5}!!! $$$" for k in range(30 + i)) for i in range(60)]
    return documents(spark, good + bad), spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")


def test_odd_rows(spark):
    docs, labels = small(spark)
    odd = documents(spark, [(500, None), (501, ""), (502, "x " * 300_000), (None, "word1 and2"), (3, "BUY1!!! $$$"), (3, "BUY1!!! $$$"), (503, " \n")])
    messy = labels.union(spark.createDataFrame([(1, None), (None, 1), (999, 0), (2, 1)], "doc_id long, quality int"))
    got = q.classify(crowded(docs.union(odd)), crowded(messy)).collect()
    assert len(got) == 127 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    first = {r.doc_id: r.score for r in got if r.doc_id is not None and r.doc_id < 120 and r.doc_id != 3}
    assert np.mean([first[i] for i in range(60) if i in first]) > 0.8 and np.mean([first[i] for i in range(60, 120)]) < 0.2
    kept = q.keep_good(docs.union(odd).withColumn("score", docs.doc_id), labels)
    assert kept.columns == ["doc_id", "text", "score"] and 55 <= kept.filter("doc_id < 120").count() <= 66


def test_labels_never_leak(spark):
    """Neither ids nor held-out labels change a score."""
    docs, labels = small(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    assert {r.doc_id: r.score for r in q.classify(docs, labels).collect()} == {r.doc_id: r.score for r in q.classify(docs, flipped).collect()}


def test_empty_tables(spark):
    docs, labels = small(spark)
    assert q.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in q.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in q.classify(docs, labels.filter("quality = 1")).collect()} == {1.0}


def test_word_vectors_are_counts():
    """Contexts added for all texts at once and one by one agree with a plain loop."""
    texts = [b"a b c a", b"", None, b"b", b"c c, a b"]
    places, signs = q.sparse_vectors()
    sums, plain = np.zeros((q.BUCKETS, q.DIMENSIONS), np.int64), np.zeros((q.BUCKETS, q.DIMENSIONS), np.int64)
    q.add_contexts(sums, texts, places, signs)
    for text in texts:
        w = q.tokens(text)
        for i in range(len(w)):
            for k in range(max(0, i - q.REACH), min(len(w), i + q.REACH + 1)):
                if k != i:
                    for s in range(q.SIGNS):
                        plain[w[i], places[w[k], s]] += signs[w[k], s]
    assert (sums == plain).all()


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 5)).astype(np.float32)
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    score = q.fit(x, y).score(x)
    assert abs(score.mean() - y.mean()) < 0.02 and abs(y[score > 0.8].mean() - score[score > 0.8].mean()) < 0.05
