import json
import os
import tempfile

from pyspark.sql import functions as F

from ledgerlake.sources import io as IO


def test_raw_typed_and_latin1_csv(spark):
    d = tempfile.mkdtemp(prefix="ll-io-")
    p = os.path.join(d, "raw.csv")
    with open(p, "w", encoding="latin-1") as f:
        f.write('Periodo_Mes,Cuentas_Cobrar_ARS,Nombre\n2025/01,"$147.123.409,81",Mendoza Ñ\n2025-02,  12,5 ,Año\n')
    raw = IO.read_raw(spark, p, ["Periodo_Mes", "Cuentas_Cobrar_ARS", "Nombre"], encoding="ISO-8859-1")
    rows = raw.collect()
    assert rows[0].Cuentas_Cobrar_ARS == "$147.123.409,81" and rows[0].Nombre == "Mendoza Ñ"
    typed = IO.read_typed(spark, p, "Periodo_Mes string, Cuentas_Cobrar_ARS double, Nombre string")
    assert typed.count() == 2


def test_json_series_map_and_report(spark):
    d = tempfile.mkdtemp(prefix="ll-io-")
    p = os.path.join(d, "series.json")
    with open(p, "w") as f:
        json.dump({"status": 200, "results": [{"idVariable": 7, "detalle": [
            {"fecha": "2024-01-02", "valor": 4500}, {"fecha": "2024-01-03", "valor": 4600}]}]}, f)
    s = IO.read_json_series(spark, p).orderBy("fecha").collect()
    assert [r.valor for r in s] == [45.0, 46.0]
    df = spark.createDataFrame([('{"Entrada": {"beta": -0.5, "n": 10}, "Icono": {"beta": 0.1, "n": 3}}',)], "j string")
    m = IO.json_map_to_rows(df, "j", "struct<beta:double,n:int>", "Segmento").orderBy("Segmento").collect()
    assert [(r.Segmento, r.beta, r.n) for r in m] == [("Entrada", -0.5, 10), ("Icono", 0.1, 3)]
    out = os.path.join(d, "report")
    IO.write_json_report(spark.createDataFrame([("Ventas", 10)], "tabla string, n int"), out)
    assert json.loads(spark.read.text(out).first().value) == {"tabla": "Ventas", "n": 10}
    assert IO.read_optional(spark, os.path.join(d, "missing"), spark.read.parquet) is None


def test_json_maps_aligned_by_key(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="ll-io-"), "maps.json")
    with open(p, "w") as f:
        json.dump({"spot": {"2024-01": 10.0, "2024-02": 11.0}, "ipc": {"2024-02": 1.5, "2024-03": 2.0}, "otro": {}}, f)
    got = IO.read_json_aligned(spark, p, ["spot", "ipc", "otro"]).orderBy("fecha").collect()
    assert [tuple(r) for r in got] == [("2024-01", 10.0, None, None), ("2024-02", 11.0, 1.5, None), ("2024-03", None, 2.0, None)]


def test_views_over_the_tables(spark):
    from conftest import SF001
    from ledgerlake.sources.tables import register_views, row_count, small
    register_views(spark, SF001, ["nation", "region"])
    assert spark.sql("select count(*) n from nation join region on n_regionkey = r_regionkey").first().n == 25
    assert row_count(spark, SF001, "nation") == 25
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    nation = spark.table("nation")
    assert "broadcast" in plan(small(nation, SF001, "nation", 100)) and "broadcast" not in plan(small(nation, SF001, "nation", 1 << 30))
