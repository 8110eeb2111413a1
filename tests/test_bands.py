from pyspark.sql import functions as F

from ledgerlake.functions.bands import band
from ledgerlake.functions.scalar import divide, norm_cdf


def test_band_boundaries_and_null(spark):
    rules = [(">=", 0.0, "CUMPLE"), (">=", -0.05, "ALERTA")]
    df = spark.createDataFrame([(0.0,), (-0.05,), (-0.0500001,), (None,)], "v double")
    got = [r[0] for r in df.select(band("v", rules, "CRITICO", on_null="SIN DATOS")).collect()]
    assert got == ["CUMPLE", "ALERTA", "CRITICO", "SIN DATOS"]
    # DAX blank compares as 0 when ISBLANK is not tested first
    got = [r[0] for r in df.select(band("v", rules, "CRITICO", null_blank=False)).collect()]
    assert got[-1] == "CUMPLE"


def test_divide_and_normal_cdf(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(divide("a", "b", 0.0)).collect()] == [0.0, 0.0, 1.5]
    assert [r[0] for r in df.select(divide("a", "b")).collect()][:2] == [None, None]
    x = spark.createDataFrame([(0.0,), (1.959964,), (-1.0,)], "x double")
    got = [r[0] for r in x.select(norm_cdf("x")).collect()]
    assert abs(got[0] - 0.5) < 1e-7 and abs(got[1] - 0.975) < 1e-6 and abs(got[2] - 0.158655) < 1e-6
