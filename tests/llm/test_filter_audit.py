"""Filter interactions against a plain simulation of every order."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from ledgerlake.llm import filter_audit
from ledgerlake.llm.filter_audit import audit, masks, min_plus, removal_steps

from .helpers import crowded

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"
NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text: str, doc_id, ids_of: dict) -> set:
    words = [w for w in "".join(" " if c in "\x20\x09\x0a\x0b\x0c\x0d" else c for c in text).split(" ") if w]
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if doc_id is not None and any(i is not None and i < doc_id for i in ids_of[text]):
        out.add("E")
    return out


def brute(rows, labels):
    ids_of = defaultdict(list)
    for i, t, _ in rows:
        ids_of[t or ""].append(i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, lang in rows:
        parts[lang or ""].append((fails(t or "", i, ids_of), i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            gone = []
            for step, f in enumerate(order, 1):
                hit = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(hit)
                out[part, "".join(order), step] = [
                    len(left), len(hit), sum(f in d[0] for d in gone), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in hit), sum(d[2] for d in hit), f]
                gone += hit
        for key in out:
            if key[0] == part:
                out[key][6] = shapley[out[key][6]]
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in NAMES) for r in df.collect()}


def corpus(seed: int, n: int):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "é\xa0à " * 120, "A" * 3, "a b $", " ".join(f"w{k}" for k in range(150)),
             "Word " * 200, " ".join(f"W{k}" for k in range(100)), "\x0b".join(f"x{k}" for k in range(101)) + "|",
             " ".join(f"long{k}" for k in range(40_000))]
    rows = [(rng.choice([None, *range(n)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(n)]
    labels = [(rng.choice([None, *range(n)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)]
    return rows + rows[:5], labels + labels[:5]


def test_brute(spark):
    rows, labels = corpus(3, 120)
    got = audit(crowded(spark.createDataFrame(rows, DOCS)), crowded(spark.createDataFrame(labels, LABELS)))
    assert found(got) == brute(rows, labels)


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], LABELS)
    assert audit(spark.createDataFrame([], DOCS), nothing).collect() == []
    rows = [(1, "x", "en")]
    assert found(audit(spark.createDataFrame(rows, DOCS), nothing)) == brute(rows, [])


def test_copies_of_one_text(spark):
    rows = [(k, "same text", "en" if k % 3 else "fr") for k in range(500)] + [(0, "same text", "es")]
    counts = {(r.part, r.mask): r.n for r in masks(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)).collect()}
    assert counts == {("fr", 1): 1, ("es", 1): 1, ("fr", 17): 166, ("en", 17): 333}


def test_steps_are_a_min_plus_product():
    a, b = np.array([[0, 9], [9, 0], [0, 0]]), np.array([[1, 2], [2, 1]])
    assert min_plus(a, b).tolist() == [[1, 2], [2, 1], [1, 1]]
    steps = removal_steps(5)
    orders = filter_audit.positions(5)[0]
    assert steps[0].tolist() == [6] * 120
    for mask in range(1, 32):
        assert steps[mask].tolist() == [min(o.index(f) + 1 for f in range(5) if mask >> f & 1) for o in orders]


def test_many_parts(spark):
    rows = [(k, f"t{k % 7}", f"part{k % 600}") for k in range(1800)]
    assert found(audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS))) == brute(rows, [])
