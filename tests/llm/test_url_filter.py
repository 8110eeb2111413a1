import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import url_filter
from ledgerlake.llm.queries import URL_RULES

from .helpers import crowded


def judge(url, rules):
    """Brute force: every rule against the URL."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[:min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = ["http://a.example.org/es/1", "https://EXAMPLE.ORG/en/12?x#y", "http://example.org", "http://example.org/", "ftp://x.com/fr/#a",
        "http://b.com/de/2", "http://notexample.org/es/", "no scheme", "", None, "://org/", "http://org/x", "http://a.b.c.d.com/fr/q",
        "http://www.Éxample.com/de/", "http://u:p@h.com:80/de/x", "http://" + "a." * 3000 + "org/" + "x" * 20000, "http://..org/", "http://com?/fr/",
        "http://x.org/a\nb", "http://x.org/es/é"]


@pytest.mark.parametrize("rules", [URL_RULES, [("block", "b.com", ""), ("allow", "com", "/de/"), ("block", "com", "/de/"), ("odd", "org", "/"),
                                               ("block", None, "/"), ("allow", "x.com", None), ("block", "X.Com", "/fr/")], []])
def test_against_brute_force(spark, rules):
    rows = list(enumerate(URLS + URLS[:3])) + [(0, URLS[1]), (None, URLS[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame(rules, "action string, host string, path string")
    known = [(a, h.lower(), p) for a, h, p in rules if a in ("allow", "block") and h and p is not None]
    got = sorted(map(tuple, url_filter.filter_urls(crowded(pages), table).collect()), key=repr)
    assert got == sorted([(i, *judge(u, known)) for i, u in rows], key=repr)


def test_empty_and_shuffled_rules(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    table = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    assert url_filter.filter_urls(pages.limit(0), table).count() == 0
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    assert url_filter.filter_urls(pages, table).select(F.col("rule")).first()[0] == "org/"
