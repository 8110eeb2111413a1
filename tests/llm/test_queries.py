"""Queries against their SQL, and against the operators' plain versions where there is none."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlake.llm.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, D)
    there = duck.execute(ORACLES[name])
    names = [c[0] for c in there.description]
    assert sorted(names) == sorted(got.columns)

    def rounded(rows):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)

    assert rounded(tuple(r[n] for n in names) for r in got.collect()) == rounded(there.fetchall())


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_secret_digest(spark):
    import hashlib

    from .test_secret_scan import brute
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    for r in QUERIES["op10_secret_scan"](spark, D).collect():
        spans = brute(docs[r.doc_id])
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans if k < 3)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
