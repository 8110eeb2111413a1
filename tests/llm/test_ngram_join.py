import random

import numpy as np
import pytest

from ledgerlake.llm import ngram_join as j

from .helpers import crowded, documents, prose


def brute(rows, words=5, percent=75):
    """(id, set size, smallest id reached) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = label[a], label[b]
                    label = [y if v == x else v for v in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[k]]
        out.append((i, len(sets[k]), None if i is None else min(ids)))
    return sorted(out, key=repr)


def corpus(seed):
    """Copies, near copies by degrees, a chain, a passage that all share, short and odd texts."""
    rng = random.Random(seed)
    line = " ".join(prose(99, 40))
    texts = []
    for g in range(12):
        base = prose(seed * 100 + g, rng.choice([6, 12, 40, 120]), 400)
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            texts.append(" ".join(w) + (" " + line if g % 2 else ""))
    chain = prose(7, 60)
    texts += [" ".join(chain[k:k + 48]) for k in range(0, 12, 2)]
    texts += [None, "", " \t\n", "a", "A", "a b", "a b c d", "A B c D", "a b c d e", "é É x", "é é x", line, line.upper(), "the " * 500, "the " * 900]
    rng.shuffle(texts)
    return list(enumerate(texts, 5))


@pytest.mark.parametrize("small, tile", [(12, 2048), (2, 4), (3, 16)])
def test_against_all_pairs(spark, monkeypatch, small, tile):
    monkeypatch.setattr(j, "SMALL", small)
    monkeypatch.setattr(j, "TILE", tile)
    rows = corpus(small)
    rows += [rows[3], rows[3], (None, rows[0][1]), (1000, "x " + rows[2][1] if rows[2][1] else "x")]
    got = sorted(map(tuple, j.jaccard_groups(crowded(documents(spark, rows))).collect()), key=repr)
    assert got == brute(rows)


def test_shuffled_id_lists(spark, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_IDS", 0)
    rows = corpus(4)
    assert sorted(map(tuple, j.jaccard_groups(documents(spark, rows)).collect()), key=repr) == brute(rows)
    kept = j.keep_one(crowded(documents(spark, rows + rows[:4])))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in brute(rows) if i == c)


def test_empty_and_long(spark):
    docs = documents(spark, [(1, " ".join(prose(1, 60_000, 50_000))), (2, " ".join(prose(1, 60_000, 50_000)[:50_000])), (3, "y")])
    assert sorted((r.doc_id, r.component_id) for r in j.jaccard_groups(docs).collect()) == [(1, 1), (2, 1), (3, 3)]
    assert j.jaccard_groups(docs.limit(0)).count() == 0


def test_bounds_never_cut_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        base = rng.integers(0, 2 ** 63, rng.integers(1, 400), dtype=np.uint64)
        a = np.unique(base[rng.random(len(base)) < 0.9])
        b = np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 2 ** 63, rng.integers(0, 40), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        assert common <= j.most_overlap(j.signature(a), j.signature(b), len(a), len(b))
        if len(a) and len(b) and 100 * common >= 75 * (len(a) + len(b) - common):
            frequent = np.sort(rng.choice(base, min(len(base), 30), replace=False))
            assert common >= j.least_overlap(len(a), len(b))
            assert set(j.prefix(a, frequent).tolist()) & set(j.prefix(b, frequent).tolist())


def test_ids_of_several_texts(spark):
    """An id whose one text is a copy keeps the links of its other text."""
    a, b = " ".join(prose(1, 40)), prose(2, 40)
    near = " ".join([*b[:-1], "other"])
    b = " ".join(b)
    rows = [(1, a), (5, a), (5, b), (9, near), (12, "no kin at all to the others here")]
    got = sorted(map(tuple, j.jaccard_groups(documents(spark, rows)).collect()), key=repr)
    assert got == brute(rows) and (9, 36, 5) in got
    kept = sorted(map(tuple, j.keep_one(crowded(documents(spark, rows))).select("doc_id", "text").collect()))
    assert kept == [(1, a), (5, b), (12, rows[4][1])]
    assert sorted(map(tuple, j.jaccard_groups(documents(spark, rows[2:])).collect()), key=repr) == brute(rows[2:])
    # the same with empty texts beside, which have no kin
    odd = [*rows, (5, None), (9, ""), (5, b)]
    kept = [tuple(r) for r in j.keep_one(documents(spark, odd)).collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (5, b), (5, None), (9, ""), (12, rows[4][1])], key=repr)
