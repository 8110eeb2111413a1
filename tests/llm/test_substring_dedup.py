import hashlib
import random

import numpy as np
import pytest

from ledgerlake.llm import substring_dedup as s

from .helpers import crowded, documents, prose


def brute(rows, window=13):
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(seed + k, n, 200) for k, n in enumerate((12, 13, 14, 30, 70, 70))]
    texts = []
    for k in range(60):
        w = prose(1000 + seed * 100 + k, rng.randrange(0, 80), 500)
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 8)
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = p[a:a + rng.randrange(9, 71)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(w))
    texts += [texts[3], texts[3], texts[9] + " ", None, "", "ha " * 40, "ha " * 60, " ".join(passages[4]), " ".join(passages[4]), " ".join(passages[4]).upper(),
              "é " * 13, "é\x0b" * 14, "é " * 15]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("words, bits", [(400_000, s.SEGMENT_BITS), (60, s.SEGMENT_BITS), (400_000, 1 << 6)])
def test_against_brute_force(spark, monkeypatch, words, bits):
    monkeypatch.setattr(s, "SHARD_WORDS", words)
    if bits != s.SEGMENT_BITS:  # too many anchors for the filter
        monkeypatch.setattr(s, "_bloom", lambda repeated: None)
    rows = corpus(words % 7)
    rows += [rows[5], (rows[8][0], rows[20][1]), (None, rows[4][1])]
    got = s.remove_repeats(crowded(documents(spark, rows))).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows)
    for r in got:
        assert sum(x.word_end - x.word for x in r.removed) == r.n_removed
        if r.n_removed:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_shuffled_lists_and_one_id_with_several_texts(spark, monkeypatch):
    monkeypatch.setattr(s, "BROADCAST_IDS", 0)
    rows = corpus(2)
    rows += [(rows[k][0], rows[k + 1][1]) for k in range(0, 40, 5)]
    got = s.remove_repeats(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows)


def test_empty_and_long(spark):
    long = " ".join(prose(1, 40_000, 30_000))
    docs = documents(spark, [(1, long), (2, "x " * 20 + long[:100_000])])
    assert s.remove_repeats(docs.limit(0)).count() == 0
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in s.remove_repeats(docs).collect())
    assert got == brute([(1, long), (2, "x " * 20 + long[:100_000])])


def test_index_counts_patterns():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 500).astype(np.int64)
    index = s.FMIndex(np.append(text, 0), 4)
    for _ in range(200):
        pattern = text[(k := rng.integers(0, 480)):k + rng.integers(1, 14)] if rng.random() < 0.8 else rng.integers(1, 4, 6)
        low, high = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            low, high = index.extend(low, high, np.array([c]))
        places = [k for k in range(len(text) - len(pattern) + 1) if (text[k:k + len(pattern)] == pattern).all()]
        assert sorted(index.order[low[0]:max(low[0], high[0])].tolist()) == places


def test_no_group_outgrows_a_shard(spark, monkeypatch):
    """A short line in most texts: its anchor's segments do not meet in one task."""
    bound, inner = 150, s._shards

    def guarded(batches, window):
        batches, words = list(batches), {}
        for b in batches:
            for anchor, segment in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                words[anchor] = words.get(anchor, 0) + segment.count(b" ") + 1
        assert max(words.values(), default=0) <= bound
        yield from inner(iter(batches), window)

    monkeypatch.setattr(s, "SHARD_WORDS", bound)
    monkeypatch.setattr(s, "_shards", guarded)
    line = "all of this is said in every text"
    texts = [" ".join([*prose(k, 20, 5000), line, *prose(k % 30 + 100, 20, 5000)]) for k in range(60)]
    texts += ["ha " * 500, "ha " * 400 + line, *corpus(5)[3][1:]]
    rows = list(enumerate(texts))
    got = s.remove_repeats(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows)
