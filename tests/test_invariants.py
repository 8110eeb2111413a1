from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake import registry
from ledgerlake.operators.etl import allocate_exact


def test_variance_closes_exactly(spark):
    registry.load_all()
    rows = registry.QUERIES["variance_3way"](spark, SF001).collect()
    assert rows and all(r.EstadoCuadratura == "CUADRATURA EXACTA ($0.00)" for r in rows)


def test_allocation_closes_to_the_cent(spark):
    amounts = spark.createDataFrame([("CC1", 1, Decimal("100.00")), ("CC1", 2, Decimal("10.01"))],
                                    "cc string, mes int, monto decimal(18,2)")
    weights = spark.createDataFrame([("CC1", "a", 1 / 3), ("CC1", "b", 1 / 3), ("CC1", "c", 1 / 3)],
                                    "cc string, cuenta string, w double")
    out = allocate_exact(amounts, weights, ["cc"], "cuenta", "monto", "w")
    tot = {r.mes: r.t for r in out.groupBy("mes").agg(F.sum("asignado").alias("t")).collect()}
    assert tot == {1: Decimal("100.00"), 2: Decimal("10.01")}


def test_miller_orr_band_order_and_var_order(spark):
    registry.load_all()
    p = registry.QUERIES["miller_orr_params"](spark, SF001).groupBy("CuentaID").pivot("Parametro").agg(F.first("Valor"))
    bad = p.filter(~((F.col("Saldo_Minimo_L") < F.col("Punto_Retorno_Z")) &
                     (F.col("Punto_Retorno_Z") < F.col("Banda_Superior_H")))).count()
    assert bad == 0
    v = registry.QUERIES["cfvar"](spark, SF001).collect()
    assert {r.HorizonteDias for r in v} == {3, 7, 14}
    for r in v:
        assert r.CF_VaR_99 >= r.CF_VaR_95 and r.CVaR_95_ExpectedShortfall >= r.CF_VaR_95


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
