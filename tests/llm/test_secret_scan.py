import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import secret_scan as s

from .helpers import crowded, documents

PIECES = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", "APIKEY", '"', "'", " ", ":", "=", "abcdefghijkl", "AKIA", "AKIAABCDEFGHIJKLMN",
          "0123456789abcdef", "f" * 40, "xyz", "\n", "é", "ſecret=abcdefghijklmnop", "Key", "toKen=aaaaaaaaaaaaaa", "ghp_" + "a" * 36, "xoxb-" + "1" * 24,
          "AIza" + "b" * 35, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12]


def brute(text):
    """Every rule's expression over every text."""
    found = []
    for k, rule in enumerate(s.RULES):
        for m in re.compile(rule.pattern, re.A | (re.I if rule.ignore_case else 0)).finditer(text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), k, m.end()))
    return sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join) | st.none(), max_size=8))
def test_index_loses_nothing(texts):
    assert s.Scanner(s.RULES).spans(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("pattern, held", [("abc", "abc"), ("ab[cd]e", "or"), ("a?bcd", "bcd"), ("[a-z]+", True), ("x(foo|bar)y", "or"), ("ab", True),
                                           ("(abc|.)", True), ("(abc){2,}", "abc"), ("(abc)*", True), ("a.bcd", "bcd")])
def test_derived_queries(pattern, held):
    query = s.trigram_query(pattern)
    assert (query is True) == (held is True) and (held is True or held in repr(query))


def test_table(spark):
    texts = [None, "", "token = 'abcdefghijklmnop' x", "é secret=ABCDEFGHIJKL", "z" * 300_000 + " " + "a" * 20, "token = 'abcdefghijklmnop' x"]
    docs = documents(spark, [*enumerate(texts), (2, texts[2])])
    got = s.scan(crowded(docs).withColumn("kind", docs.doc_id)).collect()
    assert sorted((r.doc_id, [(x.start, x.end) for x in r.spans]) for r in got) == sorted(
        (i, [(a, b) for a, _, b in brute(t)]) for i, t in [*enumerate(texts), (2, texts[2])])
    assert s.scan(docs.limit(0)).count() == 0
    masked = dict(s.redact(docs).collect())
    assert masked[0] is None and masked[1] == "" and masked[2] == "[SECRET]' x" and masked[3] == "é [SECRET]"
