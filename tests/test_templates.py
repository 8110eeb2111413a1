"""Templates: formats, branches and nulls, the same in Spark and DuckDB."""

import duckdb

from ledgerlake.functions.templates import FORMATS, column, compiled, text
from ledgerlake.plans import texts as T

VALUES = [0.0, -0.0004, 0.0005, 0.12345, -0.98765, 1.0, 12.5, -1234.5, 1234567.891, -98765432.1, None]


def both(spark, rows, schema, t):
    df = spark.createDataFrame(rows, schema)
    got = [r.t for r in df.select(column(t).alias("t")).collect()]
    con = duckdb.connect()
    names = [f.split()[0] for f in schema.split(", ")]
    duck_types = {"double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER"}
    con.execute(f"CREATE TABLE x (k INTEGER, {', '.join(f'{f.split()[0]} {duck_types[f.split()[1]]}' for f in schema.split(', '))})")
    con.executemany(f"INSERT INTO x VALUES (?, {', '.join('?' * len(names))})", [(k, *r) for k, r in enumerate(rows)])
    assert got == [r[0] for r in con.execute(f"SELECT {compiled(t, 'duckdb')} FROM x ORDER BY k").fetchall()]
    return got


def test_formats(spark):
    for form in FORMATS:
        if form:
            both(spark, [(v,) for v in VALUES], "v double", text((None, "a {v:" + form + "} b")))
    assert both(spark, [(0.1234,), (-0.0004,), (None,)], "v double", text((None, "{v:pct1}"))) == ["12.3%", "0.0%", ""]
    assert both(spark, [(2345678.0,), (-50_000.0,), (0.0,)], "v double", text((None, "{v:change}|{v:millions}|{v:money}"))) == [
        "+$2.3 M|$2.3 M|$2,345,678", "-$0.1 M|$0.1 M|$-50,000", "$0.0 M|$0.0 M|$0"]


def test_branches_and_quotes(spark):
    t = text(("v IS NULL", "it's {s} nothing"), ("v >= 0", "up {v:dec2}"), ("v < -5", "{s}"))
    assert both(spark, [(None, "a"), (1.5, "b"), (-1.0, "c"), (-9.0, "o'x"), (-9.0, None)], "v double, s string", t) == ["it's a nothing", "up 1.50", None, "o'x", ""]
    assert both(spark, [(1,)], "n int", text((None, "plain"))) == ["plain"]


def test_summary(spark):
    row = ("CUMPLE", 2024, 0.031, 0.02, "Línea x")
    df = spark.createDataFrame([row, ("CRITICO", 2025, None, 0.123, "Línea y")], "Estado string, Anio int, VariacionYoY double, DesvioAbs double, TopCausa string")
    out = [r.ResumenEjecutivo for r in T.with_texts(df, T._CTL_TEXTS).collect()]
    assert out[0] == "SITUACION: En objetivo para 2024 (todos los meses). El cumplimiento es positivo con +3.1% vs. año anterior. Impulsor principal: Línea x."
    assert out[1].startswith("ACCION URGENTE: Desvio critico (12.3% bajo plan) en 2025 (todos los meses). Sin periodo anterior comparable. ")


def test_top_members_keep_ties(spark):
    df = spark.createDataFrame([(1, "b", -0.2), (1, "a", 0.2), (1, "c", 0.1), (2, "x", None)], "y int, m string, v double")
    got = {r.y: (r.TopCausa, r.Magnitud) for r in T.top_members(df, ["y"], "m", "v", "L ").collect()}
    assert got == {1: ("L a, L b", 0.2), 2: ("L x", 0.0)}
