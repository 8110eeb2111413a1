"""Results that are known from how the data were made."""
import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import checks as K
from ledgerlake.operators import etl as E
from ledgerlake.plans import budget as BU
from ledgerlake.plans import causal as CA
from ledgerlake.plans import conform as CO
from ledgerlake.plans import model as M
from ledgerlake.plans import risk as RI
from ledgerlake.plans import series as SE
from ledgerlake.plans import treasury as TR
from ledgerlake.session import materialise, release


def _sales(spark, rows):
    """(date, sku, line, segment, channel, centre, volume, revenue, cost) -> the sales fact."""
    df = spark.createDataFrame(rows, "Fecha date, ProductoID int, Linea string, Segmento string, CanalVenta string, CentroCostoID string, "
                                     "VolumenReal decimal(12,2), IngresosReales decimal(18,4), CostoReal decimal(18,4)")
    return (df.withColumn("Anio", F.year("Fecha")).withColumn("Mes", F.month("Fecha"))
            .withColumn("MesDateKey", F.col("Anio") * 10000 + F.col("Mes") * 100 + 1).withColumn("AnioMes", F.date_format("Fecha", "yyyy-MM"))
            .withColumn("MargenBrutoReal", F.col("IngresosReales") - F.col("CostoReal")).withColumn("FacturacionBruta", F.col("IngresosReales")))


def test_planted_elasticity(spark):
    rnd = random.Random(1)
    rows = []
    for sku in range(40):
        level = rnd.uniform(4, 7)
        for t in range(36):
            if rnd.random() < 0.2:
                continue  # an unbalanced panel
            price = math.exp(rnd.gauss(2, 0.4) + 0.1 * (t % 12 == 11))
            beta = -0.85 if sku % 2 else -0.3
            rows.append((sku, "A" if sku % 2 else "B", t % 12 + 1, math.log(price), level + 0.2 * (t % 12) + beta * math.log(price) + rnd.gauss(0, 0.05)))
    panel = spark.createDataFrame(rows, "ProductoID int, Segmento string, Mes int, x double, y double")
    got = {r.Segmento: r for r in SE.price_elasticity(panel).collect()}
    assert abs(got["A"].Beta_Elasticidad + 0.85) < 0.15 and abs(got["B"].Beta_Elasticidad + 0.3) < 0.15
    assert got["A"].Significativo and -0.85 < got["GLOBAL"].Beta_Elasticidad < -0.3
    check = SE.economic_order_check(SE.price_elasticity(panel), ["A"], ["B"]).first()
    assert check.Chequeo == SE.ORDER_OK
    assert SE.economic_order_check(SE.price_elasticity(panel), ["A"], ["Z"]).first().Chequeo == SE.ORDER_UNKNOWN
    lone = SE.price_elasticity(panel.filter("ProductoID = 1 and Mes < 3").limit(2)).collect()
    assert all(r.Beta_Elasticidad is None and not r.Significativo for r in lone)


def test_known_growth_at_every_grain(spark):
    rows = []
    for year, factor in ((2020, 1.0), (2021, 1.1), (2022, 1.21)):
        for month in range(1, 13 if year < 2022 else 7):
            for sku, line, amount in ((1, "L1", 100.0), (2, "L2", 300.0)):
                rows.append((dt.date(year, month, 15), sku, line, "S", "C", "CC", Decimal("1.00"), Decimal(str(round(amount * factor, 4))), Decimal("1")))
    cube = materialise(_sales(spark, rows))
    yoy = [m for m in M.CTL if m[0] in {"IngresosReales", "RealAnioAnterior", "VariacionYoY"}]
    by_month = {r.AnioMes: r for r in M.evaluate(spark, "", yoy, ["AnioMes"], cube=cube).collect()}
    assert by_month["2020-05"].RealAnioAnterior is None
    assert all(abs(by_month[f"{y}-{m:02d}"].VariacionYoY - 0.1) < 1e-9 for y, ms in ((2021, 12), (2022, 6)) for m in range(1, ms + 1))
    by_year = {r.Anio: r for r in M.evaluate(spark, "", yoy, ["Anio"], cube=cube).collect()}
    assert abs(by_year[2021].VariacionYoY - 0.1) < 1e-9 and abs(by_year[2022].RealAnioAnterior - 6 * 440) < 1e-6
    lines = {r.Linea: r for r in M.evaluate(spark, "", yoy, ["Linea"], cube=cube, total=True).collect()}
    assert abs(lines["L1"].RealAnioAnterior - (1200 + 6 * 110)) < 1e-6 and abs(lines[None].RealAnioAnterior - 4 * (1200 + 6 * 110)) < 1e-6
    sliced = M.evaluate(spark, "", yoy, ["Linea"], {"AnioMes": ["2021-03"]}, cube=cube).collect()
    assert {(r.Linea, round(r.RealAnioAnterior, 4)) for r in sliced} == {("L1", 100.0), ("L2", 300.0)}


def test_missing_dimensions_and_removed_filters(spark):
    rows = [(dt.date(2020, 1, 1), 1, "L1", "S", c, "CC", Decimal(v), Decimal(v), Decimal("1")) for c, v in (("C1", "2"), ("C2", "6"))]
    cube = materialise(_sales(spark, rows))
    ms = [("a", "ing_real"), ("b", "vol_real")]
    got = M.evaluate(spark, "", ms, ["CanalVenta"], {"CanalVenta": ["C1"]}, remove={"vol_real": ["CanalVenta"]}, cube=cube).collect()
    assert [(r.CanalVenta, r.a, r.b) for r in got] == [("C1", 2.0, 8.0)]
    with pytest.raises(ValueError):
        M.evaluate(spark, "", ms, ["Nada"], cube=cube)


def test_budget_is_a_full_grid(spark):
    rows = [(dt.date(2020, m, 3), k, f"L{k}", "S", "C", c, Decimal("4"), Decimal("40"), Decimal("20")) for m, k, c in ((1, 1, "X"), (2, 2, "Y"), (12, 1, "X"))]
    rows += [(dt.date(2021, 1, 3), 1, "L1", "S", "C", "X", Decimal("5"), Decimal("60"), Decimal("25"))]
    b = BU.budget_prior_year(_sales(spark, rows)).collect()
    assert len(b) == 4 * 2 * 2 and sum(r.VolumenPresupuestado for r in b if r.Anio == 2020) == 12
    assert [(r.ProductoID, r.CentroCostoID, r.VolumenPresupuestado) for r in b if r.Anio == 2021 and r.VolumenPresupuestado] == [("L1", "X", 4)]


def test_holding_period_sums(spark):
    days = [(1, dt.date(2024, 1, d), float(d)) for d in (1, 2, 4, 5)] + [(2, dt.date(2024, 1, 1), -3.0)]
    flows = spark.createDataFrame(days, "CuentaID long, Fecha date, FlujoNetoDiario double")
    got = sorted((r.CuentaID, r.HorizonteDias, r.acc) for r in TR.horizon_sums(flows, (1, 3)).collect())
    assert got == [(1, 1, 0.0), (1, 1, 1.0), (1, 1, 2.0), (1, 1, 4.0), (1, 1, 5.0), (1, 3, 3.0), (1, 3, 6.0), (1, 3, 9.0), (2, 1, -3.0)]
    risk = {(r.CuentaID, r.HorizonteDias): r for r in TR.cfvar(flows, (1, 3), lower=10.0).collect()}
    assert risk[2, 1].CF_VaR_95 == 3.0 and risk[2, 1].BufferLiquidezRequerido == 13.0 and risk[1, 3].CF_VaR_95 == 0.0


def test_confusion_matrix_keeps_empty_quadrants(spark):
    m = RI.classification_metrics(spark.createDataFrame([(1, 0.9), (1, 0.8)], "label int, p double")).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 0, 0, 0)


def test_effect_from_moments_is_the_effect_from_residuals(spark):
    rnd = random.Random(2)
    rows = [(f"t{c}", "m", 2000, d := c + rnd.random(), 2.0 * d + 5 * c + rnd.gauss(0, 0.1)) for c in range(4) for _ in range(200)]
    r = CA.dml_ate(CA.cell_moments(spark.createDataFrame(rows, "p_type string, c_mktsegment string, anio int, D double, Y double"))).first()
    assert abs(r.CoeficienteEstimado - 2.0) < 0.05 and r.Benchmark_OLS_Ingenuo > 5 and r.Significativo_P05


def test_upsert_unpivot_split_and_weights(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    up = E.upsert_rows(base, spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), ["k"])
    assert sorted(map(tuple, up.collect())) == [("a", 1), ("b", 9), ("c", 3)]
    wide = spark.createDataFrame([("p", 1.0, 10.0, 2.0, None), ("p", 4.0, 1.0, 0.0, 5.0)], "p string, Ene_Vol double, Ene_Ing double, Feb_Vol double, Feb_Ing double")
    got = sorted(map(tuple, E.unpivot_months(wide, ["p"], wide.columns[1:]).select("p", "MesNumero", "Vol", "Ing").collect()))
    assert got == [("p", 1, 5.0, 11.0), ("p", 2, 2.0, 5.0)]  # repeated rows add up
    both = E.split_union(spark.createDataFrame([(1,), (5,), (None,)], "v int"), F.col("v") > 3, lambda x: x.select((F.col("v") * 10).cast("int").alias("v")))
    assert sorted((r.v for r in both.collect()), key=repr) == [1, 50, None]
    w = E.season_weights(spark.createDataFrame([("c", "m", True, 0.5), ("c", "m", False, 0.2)], "cc string, cta string, en_temporada boolean, peso double"), [2, 3])
    assert {r.Mes: r.peso for r in w.collect()} == {m: 0.5 if m in (2, 3) else 0.2 for m in range(1, 13)}


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame([("A", 1, 3), ("X", 2, 1), ("X", 2, None)], "c string, lo int, hi int")
    one = lambda x: x.first().violaciones
    assert one(K.domain_set(df, "c", ["A", "N"], "t")) == 2 and one(K.domain_set(df, "c", ["A", "X"], "t")) == 0
    assert one(K.ordered(df, ["lo", "hi"], "t")) == 2 and one(K.min_obs(df, ["c"], 2, "t")) == 1
    assert one(K.in_band(df, F.avg("lo"), 1, 2, "t", "r")) == 0 and one(K.in_band(df, F.avg("lo"), 2, 3, "t", "r")) == 1
    assert one(K.totals_close(df, df, ["lo"], "t")) == 0 and one(K.totals_close(df, df.limit(1), ["lo"], "t")) == 1
    months = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 4, 1),)], "m date")
    assert sorted(r.mes for r in K.missing_months(months, "m").collect()) == [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    years = spark.createDataFrame([(2020,), (2021,)], "y int")
    assert CO.year_or_all(years, "y", 2020).count() == 1 and CO.year_or_all(years, "y", 1999).count() == 2


def test_files_are_removed_after_use(spark):
    release(spark)
    assert materialise(spark.range(3)).count() == 3
    assert release(spark) == 1 and release(spark) == 0
