"""Spark query vs DuckDB oracle on sf0.001 (the driver does the same at sf0.01)."""
import math

import duckdb
import pytest

from conftest import SF001
from ledgerlake import registry
from ledgerlake.sources.tables import TABLES

registry.load_all()
KEYS = sorted(registry.ORACLES)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return 0.0
        return float(f"{v:.6g}") if abs(v) < 1e-3 else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return float(v) if v.__class__.__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = registry.QUERIES[key](spark, SF001)
    res = con.execute(registry.ORACLES[key])
    dcols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    srows = sorted(repr(tuple(_norm(r[c]) for c in order)) for r in sdf.collect())
    drows = sorted(repr(tuple(_norm(dict(zip(dcols, r))[c]) for c in order)) for r in res.fetchall())
    assert srows == drows
