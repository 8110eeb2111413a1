import random
import re

from ledgerlake.llm import decontamination as d

from .helpers import crowded, documents


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items, window=10):
    w, hit, who = words(text), set(), set()
    for item, t in items:
        q = words(t)
        size = min(window, len(q))
        runs = {tuple(q[i:i + size]) for i in range(len(q) - size + 1)} if size and item is not None else set()
        for i in range(len(w) - size + 1 if size else 0):
            if tuple(w[i:i + size]) in runs:
                hit |= set(range(i, i + size))
                who.add(str(item))
    return len(w), len(hit), sorted(who)


def cases():
    rng = random.Random(1)
    items = [(i, " ".join(f"q{rng.randrange(9)}" for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(None, "q1 q2"), (20, None), (21, ""), (22, "..."), (3, "Été Zoë"), (30, items[5][1])]
    docs = [" ".join(f"q{rng.randrange(9)}" for _ in range(rng.randrange(60))) for _ in range(30)]
    docs += [f"x, {items[k][1].upper()}! y-" for k in range(12)] + [None, "", "!!", "ÉTÉ été zoë", "a" * 200_000 + " q1 " * 20_000 + "été Zoë"]
    return list(enumerate(docs)) + [(5, docs[5])], items


def test_against_brute_force(spark):
    docs, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string")
    for chars in (d.PATTERN_CHARS, 400):  # one automaton, several
        got = d.decontaminate(crowded(documents(spark, docs)), crowded(table), pattern_chars=chars).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sorted((i, *brute(t, items)) for i, t in docs)
        for r in got:
            text = dict(docs)[r.doc_id]
            assert sum(x.word_end - x.word for x in r.spans) == r.n_hit
            assert all(words(text[x.start:x.end]) == words(text)[x.word:x.word_end] for x in r.spans)
        clean = d.keep_clean(documents(spark, docs), table, pattern_chars=chars)
        assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, t in docs if not brute(t, items)[1])


def test_empty_tables(spark):
    docs, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert d.decontaminate(documents(spark, docs).limit(0), table).count() == 0
    assert all(r.n_hit == 0 for r in d.decontaminate(documents(spark, docs), table.limit(0)).collect())
