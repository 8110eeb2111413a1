import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import clean as C


def _one(spark, col, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_parse_date_layouts(spark):
    vals = ["2021-03-05", "05/03/2021", "2021/03/05", "05-03-2021", "20210305", "2021-03", "2021/3",
            "12/25/2021", " 2021-3-5 ", "sin fecha", None, "202112", "2024-01-05 00:00:00", "2024-01-05T10:30", "15.01.2024", "5/1/24",
            "15-Jan-2024", "15 Feb 2024", "15-1-2024", "99/99/2024", "2024-13-45"]
    got = _one(spark, C.parse_date(F.col("v")), vals)
    d = dt.date
    assert got == [d(2021, 3, 5), d(2021, 3, 5), d(2021, 3, 5), d(2021, 3, 5), d(2021, 3, 5), d(2021, 3, 1),
                   d(2021, 3, 1), d(2021, 12, 25), d(2021, 3, 5), None, None, None, d(2024, 1, 5), d(2024, 1, 5), d(2024, 1, 15),
                   d(2024, 1, 5), d(2024, 1, 15), d(2024, 2, 15), d(2024, 1, 15), None, None]


def test_clean_number(spark):
    vals = ["$1.234,56", "1,234.56", "12,5", "1.234.567", None, "ARS 100", " $ 7 ", "n/a", "3.5", "12D", "1f", "0x1p3", "nan", "-1.5", ".5", "1e3"]
    got = _one(spark, C.clean_number(F.col("v")), vals)
    assert got == [1234.56, 1234.56, 12.5, 0.0, 0.0, 100.0, 7.0, 0.0, 3.5, 0.0, 0.0, 0.0, 0.0, -1.5, 0.5, 1000.0]


def test_clean_string_and_title(spark):
    got = _one(spark, C.clean_string(F.col("v"), "title"), ["  cabernet-franc   o'higgins ", None])
    assert got == ["Cabernet-Franc O'Higgins", ""]
    assert _one(spark, C.clean_string(F.col("v"), "upper"), [" a  b "]) == ["A B"]


def test_normalise_id_and_map(spark):
    got = _one(spark, C.normalise_id(F.col("v"), "REM-"), ["rem 12", "REM/7", "x_abc"])
    assert got == ["REM-00012", "REM-00007", "REM-x-abc"]
    got = _one(spark, C.normalise_id(F.col("v"), "REM-", numeric_prefix="REM-2025-"), ["rem 12", "x_abc"])
    assert got == ["REM-2025-00012", "REM-x-abc"]
    got = _one(spark, C.map_values(F.col("v"), {"FOB": "Exportacion Directa"}, "Canal Horeca"), ["FOB", "XX"])
    assert got == ["Exportacion Directa", "Canal Horeca"]


def test_changed_counts_null_vs_empty(spark):
    df = spark.createDataFrame([(None, ""), ("a", "a"), ("a ", "a")], "r string, c string")
    assert [r[0] for r in df.select(C.changed("r", "c")).collect()] == [1, 0, 1]


def test_replace_and_impute(spark):
    assert _one(spark, C.replace_values("v", ["", "n/a"], "x"), ["a", "", "n/a", None]) == ["a", "x", "x", "x"]
    df = spark.createDataFrame([(5.0, 9.0), (None, 9.0), (0.0, 9.0), (-1.0, None)], "v double, f double")
    assert [r[0] for r in df.select(C.impute_from_expr("v", "f")).collect()] == [5.0, 9.0, 9.0, None]
