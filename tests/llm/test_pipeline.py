"""The pipeline against a brute-force version of its stages, on the small table."""

import corpus_pipeline
from ledgerlake.llm import quality, secret_scan, sentencepiece_codec
from ledgerlake.llm.common import table

from . import test_decontamination, test_ngram_join, test_secret_scan

D = "/root/testdata/sf0.001"


def expected(spark, docs, sf_dir):
    """(doc_id, text before encoding); the fitted classifier's decisions are taken as they are."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = {r.doc_id for r in quality.classify(docs, table(spark, sf_dir, "labels")).collect() if r.predicted}
    rows = [r for r in rows if r[0] in good]
    first = {i for i, _, c in test_ngram_join.brute(rows) if i == c}
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    grams = set()
    for _, t in items:
        w = test_decontamination.words(t)
        size = min(10, len(w))
        grams |= {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if size else set()
    sizes = {len(g) for g in grams}

    def hit(text):
        w = test_decontamination.words(text)
        return any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1))

    out = {}
    for i, text in rows:
        if i in first and not hit(text):
            spans, done, parts = test_secret_scan.brute(text), 0, ""
            for a, _, b in spans:
                if a >= done:
                    parts += text[done:a] + "[SECRET]"
                done = max(done, b)
            out[i] = parts + text[done:] if spans else text
    return out


def test_run(spark):
    want = expected(spark, table(spark, D, "documents"), D)
    codec = sentencepiece_codec.Codec(sentencepiece_codec.load())
    got = corpus_pipeline.run(spark, D).collect()
    assert {r.doc_id for r in got} == set(want) and len(got) == len(want)
    assert all(r.exact and codec.decode(r.token_ids) == want[r.doc_id] for r in got)
    assert any("[SECRET]" in t for t in want.values()) and len(want) > 100


def test_stages_keep_the_columns(spark):
    docs = table(spark, D, "documents")
    odd = spark.createDataFrame([(9001, None, "en", None, None), (9002, "", None, "s", 0), (9003, "token = 'abcdefghijklmnop' é", "en", "s", 30)], docs.schema)
    docs = docs.limit(60).union(odd).withColumn("score", docs.doc_id)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, D).columns == docs.columns
    masked = {r.doc_id: r for r in corpus_pipeline.mask_secrets(spark, docs, D).collect()}
    assert masked[9001].text is None and masked[9001].n_chars is None and masked[9002].n_chars == 0
    assert masked[9003].text == "[SECRET]' é" and masked[9003].n_chars == 11
    assert secret_scan.redact(docs.limit(0)).count() == 0


def test_empty_table(spark):
    docs = table(spark, D, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, D).count() == 0
