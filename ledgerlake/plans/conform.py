"""Conforming jobs: plant expenses re-allocated to accounts with season weights,
account upsert, month unpivot, the remaining dataset checks, and the small
window forms (row-wise shares, curve points, deflators, year fallback)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import clean as C
from ledgerlake.operators import checks as K
from ledgerlake.operators import etl as E
from ledgerlake.operators import windows as W
from ledgerlake.plans import budget as BU
from ledgerlake.plans import treasury as TR
from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources import bridge as B
from ledgerlake.sources.tables import read

# Levels of the query: plant cost centres, months of the season, and per centre
# the accounts with their share in the season and in the rest of the year.
PLANT = ["NATION_1", "NATION_2", "NATION_3"]
SEASON = [2, 3, 4, 5]
WEIGHTS = [("NATION_1", "P1", True, 0.6), ("NATION_1", "P2", True, 0.25), ("NATION_1", "P3", True, 0.15),
           ("NATION_1", "P1", False, 0.4), ("NATION_1", "P2", False, 0.4), ("NATION_1", "P3", False, 0.2),
           ("NATION_2", "P2", True, 0.7), ("NATION_2", "P3", True, 0.3), ("NATION_2", "P2", False, 0.7), ("NATION_2", "P3", False, 0.3),
           ("NATION_3", "P3", True, 0.7), ("NATION_3", "P4", True, 0.3), ("NATION_3", "P3", False, 0.7), ("NATION_3", "P4", False, 0.3)]


def reallocated_opex(gastos: DataFrame, weights: DataFrame, plant: list[str], season: list[int]) -> DataFrame:
    """Expenses of the plant centres split over accounts by month's weights, exact
    to the cent (the last account takes the residual); other rows stay."""
    monthly = E.season_weights(weights, season)

    rows = gastos.select("DateKey", "AnioMes", "CentroCostoID", "CuentaID", F.col("OPEXReal").cast("decimal(18,2)").alias("OPEXReal"),
                         F.col("OPEXPresupuestado").cast("decimal(18,2)").alias("OPEXPresupuestado"))
    both = rows.select("DateKey", "AnioMes", "CentroCostoID", "CuentaID", F.expr(
        "stack(2, 'OPEXReal', OPEXReal, 'OPEXPresupuestado', OPEXPresupuestado) as (medida, monto)"))

    def split_amounts(part: DataFrame) -> DataFrame:
        total = part.groupBy("DateKey", "AnioMes", "CentroCostoID", "medida").agg(F.sum("monto").cast("decimal(18,2)").alias("monto"))
        total = total.withColumn("Mes", (F.floor(F.col("DateKey") / 100) % 100).cast("int"))
        out = E.allocate_exact(total, monthly, ["CentroCostoID", "Mes"], "CuentaID", "monto", "peso", "asignado")
        return out.select("DateKey", "AnioMes", "CentroCostoID", "CuentaID", "medida", F.col("asignado").alias("monto"))

    long = E.split_union(both, F.col("CentroCostoID").isin(plant), split_amounts)
    return long.groupBy("DateKey", "AnioMes", "CentroCostoID", "CuentaID").pivot("medida", ["OPEXReal", "OPEXPresupuestado"]).agg(F.sum("monto"))


_W = ", ".join(f"('{a}', '{b}', {str(c).lower()}, {w})" for a, b, c, w in WEIGHTS)
_REALLOCATED_SQL = with_ctes(B.GASTOS_SQL, f"w(cc, cta, alta, peso) AS (VALUES {_W})", f"""g AS (
  SELECT DateKey, AnioMes, CentroCostoID AS cc, CuentaID AS cta, CAST(OPEXReal AS DECIMAL(18,2)) AS r, CAST(OPEXPresupuestado AS DECIMAL(18,2)) AS p FROM gastos)""", f"""tot AS (
  SELECT DateKey, AnioMes, cc, SUM(r) AS r, SUM(p) AS p FROM g WHERE cc IN {tuple(PLANT)} GROUP BY 1, 2, 3)""", f"""part AS (
  SELECT t.*, w.cta, w.cta = max(w.cta) OVER (PARTITION BY t.cc, t.DateKey) AS es_ultima,
         round(t.r * CAST(w.peso AS DECIMAL(18,8)), 2) AS ar, round(t.p * CAST(w.peso AS DECIMAL(18,8)), 2) AS ap
  FROM tot t JOIN w ON w.cc = t.cc AND w.alta = ((t.DateKey // 100) % 100 IN {tuple(SEASON)}))""", """fin AS (
  SELECT DateKey, AnioMes, cc, cta,
         CASE WHEN es_ultima THEN r - (SUM(ar) OVER k - ar) ELSE ar END AS r, CASE WHEN es_ultima THEN p - (SUM(ap) OVER k - ap) ELSE ap END AS p
  FROM part WINDOW k AS (PARTITION BY cc, DateKey))""") + f"""SELECT DateKey, AnioMes, cc AS CentroCostoID, cta AS CuentaID, CAST(r AS DOUBLE) AS OPEXReal, CAST(p AS DOUBLE) AS OPEXPresupuestado
FROM (SELECT * FROM fin UNION ALL SELECT * FROM g WHERE cc NOT IN {tuple(PLANT)}) u"""


def _reallocated(spark, d) -> DataFrame:
    weights = spark.createDataFrame(WEIGHTS, "CentroCostoID string, CuentaID string, en_temporada boolean, peso double")
    return reallocated_opex(B.gastos_operativos(spark, d), weights, PLANT, SEASON)


@query("opex_reallocated", _REALLOCATED_SQL)
def q_opex_reallocated(spark, d):
    """Plant expenses on the plant accounts, other expenses as they were."""
    r = _reallocated(spark, d)
    return r.select("DateKey", "AnioMes", "CentroCostoID", "CuentaID", *[F.col(c).cast("double").alias(c) for c in ("OPEXReal", "OPEXPresupuestado")])


# Levels of the query: accounts to put in, one of them already there.
NEW_ACCOUNTS = [("P1", "Materia prima"), ("P2", "Mano de obra"), ("A", "Insumos secos y embalaje")]


@query("upsert_accounts", f"""SELECT CuentaID, NombreCuenta FROM (VALUES {', '.join(str(x) for x in NEW_ACCOUNTS)}) n(CuentaID, NombreCuenta)
UNION ALL SELECT DISTINCT l_returnflag, {B.ACCOUNT_NAME} FROM lineitem WHERE l_returnflag NOT IN ({', '.join(repr(k) for k, _ in NEW_ACCOUNTS)})""")
def q_upsert_accounts(spark, d):
    """The chart of accounts with rows replaced by key and new ones added."""
    return E.upsert_rows(B.plan_cuentas(spark, d), spark.createDataFrame(NEW_ACCOUNTS, "CuentaID string, NombreCuenta string"), ["CuentaID"])


_SHORT = [m[:3] for m in E.MONTH_NAMES]


@query("unpivot_budget", with_ctes(B.ventas_sql(), BU.budget_sql()) + """SELECT ProductoID, CentroCostoID, Anio, CAST(Mes AS INT) AS MesNumero,
  CAST(SUM(VolumenPresupuestado) AS DOUBLE) AS Vol, round(CAST(SUM(IngresosPresupuestados) AS DOUBLE), 2) AS Ing FROM presupuesto GROUP BY 1, 2, 3, 4""")
def q_unpivot_budget(spark, d):
    """The plan laid out wide by month (``Ene_Vol``, ``Ene_Ing`` ...) and brought
    back to tidy rows; months that a year does not have stay out."""
    b = BU.presupuesto(spark, d)
    cells = [F.sum(F.when(F.col("Mes") == k + 1, F.col(c)).cast("double")).alias(f"{m}_{name}")
             for k, m in enumerate(_SHORT) for name, c in (("Vol", "VolumenPresupuestado"), ("Ing", "IngresosPresupuestados"))]
    wide = b.groupBy("ProductoID", "CentroCostoID", "Anio").agg(*cells)
    ids = ["ProductoID", "CentroCostoID", "Anio"]
    tidy = E.unpivot_months(wide, ids, [c for c in wide.columns if c not in ids])
    return tidy.filter("Vol is not null").select(*ids, "MesNumero", "Vol", F.round("Ing", 2).alias("Ing"))


@query("dataset_checks", with_ctes(B.ventas_sql(), B.GASTOS_SQL, B.flujos_sql(True), TR.params_sql()) + """SELECT * FROM (
  SELECT 'lineitem' AS tabla, 'domain_set_l_returnflag' AS regla, CAST((SELECT COUNT(*) FROM (SELECT DISTINCT l_returnflag FROM lineitem EXCEPT SELECT unnest(['A', 'N', 'R'])) a)
    + (SELECT COUNT(*) FROM (SELECT unnest(['A', 'N', 'R']) EXCEPT SELECT l_returnflag FROM lineitem) b) AS BIGINT) AS violaciones
  UNION ALL SELECT 'gastos', 'totals_close', CAST(abs(a.r - b.r) >= 0.01 AS BIGINT) + CAST(abs(a.p - b.p) >= 0.01 AS BIGINT)
  FROM (SELECT SUM(CAST(OPEXReal AS DECIMAL(18,2))) AS r, SUM(CAST(OPEXPresupuestado AS DECIMAL(18,2))) AS p FROM gastos) a,
       (SELECT SUM(CAST(OPEXReal AS DECIMAL(18,2))) AS r, SUM(CAST(OPEXPresupuestado AS DECIMAL(18,2))) AS p FROM (""" + _REALLOCATED_SQL + """) z) b
  UNION ALL SELECT 'ventas', 'min_obs_24', COUNT(*) FROM (SELECT Linea FROM ventas GROUP BY Linea HAVING COUNT(DISTINCT MesDateKey) < 24) s
  UNION ALL SELECT 'ventas', 'margen_en_banda', CASE WHEN SUM(MargenBrutoReal)::DOUBLE / SUM(IngresosReales)::DOUBLE BETWEEN 0.25 AND 0.75 THEN 0 ELSE 1 END FROM ventas
  UNION ALL SELECT 'miller_orr', 'ordering_L_z_h', COUNT(*) FILTER (WHERE NOT (L < z AND z < h)) FROM params) c""")
def q_dataset_checks(spark, d):
    """Domain set, unchanged totals, least observations, band and ordering.  Totals
    are compared before and after the re-allocation of expenses."""
    gastos = B.gastos_operativos(spark, d).select(F.col("OPEXReal").cast("decimal(18,2)").alias("OPEXReal"),
                                                 F.col("OPEXPresupuestado").cast("decimal(18,2)").alias("OPEXPresupuestado"))
    v = B.ventas(spark, d)
    flows = B.flujos(spark, d, per_user=True)
    out = K.domain_set(read(spark, d, "lineitem", "l_returnflag"), "l_returnflag", ["A", "N", "R"], "lineitem")
    for part in (K.totals_close(gastos, _reallocated(spark, d), ["OPEXReal", "OPEXPresupuestado"], "gastos"),
                 K.min_obs(v.select("Linea", "MesDateKey").distinct(), ["Linea"], 24, "ventas"),
                 K.in_band(v, F.sum("MargenBrutoReal").cast("double") / F.sum("IngresosReales").cast("double"), 0.25, 0.75, "ventas", "margen_en_banda"),
                 K.ordered(TR.miller_orr_params(flows, TR.market_rate(B.mercado(spark, d))), ["L", "z", "h"], "miller_orr")):
        out = out.unionByName(part)
    return out


@query("missing_months", with_ctes(B.ventas_sql(channel=False, product=False)) + """SELECT ProductoID, CAST(COUNT(*) AS BIGINT) AS MesesFaltantes FROM (
  SELECT ProductoID, CAST(unnest(generate_series(date_trunc('month', min(Fecha)), date_trunc('month', max(Fecha)), INTERVAL 1 MONTH)) AS DATE) AS mes FROM ventas GROUP BY ProductoID) f
WHERE (ProductoID, mes) NOT IN (SELECT ProductoID, CAST(date_trunc('month', Fecha) AS DATE) FROM ventas) GROUP BY ProductoID""")
def q_missing_months(spark, d):
    """Months without sales inside each SKU's span."""
    m = B.ventas(spark, d, channel=False, product=False).select("ProductoID", F.trunc("Fecha", "month").alias("mes")).distinct()
    full = m.groupBy("ProductoID").agg(F.explode(F.sequence(F.min("mes"), F.max("mes"), F.expr("INTERVAL 1 MONTH"))).alias("mes"))
    return full.join(m, ["ProductoID", "mes"], "left_anti").groupBy("ProductoID").agg(F.count(F.lit(1)).alias("MesesFaltantes"))


# Levels of the query: class by product line.
LINE_CLASS = {"Brand#1": "A", "Brand#2": "A", "Brand#3": "B"}


@query("abc_by_line", f"""SELECT p_partkey AS ProductoID, {C.map_values_sql('p_brand', LINE_CLASS, 'C')} AS ClaseLinea FROM part""")
def q_abc_by_line(spark, d):
    """A class that depends on the product line alone."""
    return read(spark, d, "part", "p_partkey", "p_brand").select(F.col("p_partkey").alias("ProductoID"), C.map_values("p_brand", LINE_CLASS, "C").alias("ClaseLinea"))


@query("cum_share_rows", with_ctes(B.ventas_sql(channel=False)) + """SELECT Linea, ProductoID, round(CAST(SUM(ing) OVER (PARTITION BY Linea ORDER BY ing DESC, ProductoID ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  / CAST(SUM(ing) OVER (PARTITION BY Linea) AS DOUBLE), 10) AS ParteAcumulada FROM (SELECT Linea, ProductoID, SUM(IngresosReales) AS ing FROM ventas GROUP BY 1, 2) g""")
def q_cum_share_rows(spark, d):
    """Row-wise cumulative share of revenue within each line."""
    g = B.ventas(spark, d, channel=False).groupBy("Linea", "ProductoID").agg(F.sum("IngresosReales").alias("ing"))
    return W.cum_share_rows(g, "ing", ["Linea"], "c").select("Linea", "ProductoID", F.round("c", 10).alias("ParteAcumulada"))


POINTS = 50


@query("curve_points", with_ctes(B.ventas_sql(channel=False, product=False), """r AS (
  SELECT Anio, ProductoID, row_number() OVER (PARTITION BY Anio ORDER BY ing, ProductoID) AS k, COUNT(*) OVER (PARTITION BY Anio) AS n, ing
  FROM (SELECT Anio, ProductoID, SUM(IngresosReales) AS ing FROM ventas GROUP BY 1, 2) g)""") + f"""SELECT Anio, CAST(i AS INT) AS Punto, CAST(ing AS DOUBLE) AS Ingresos
FROM r JOIN (SELECT unnest(range(0, {POINTS})) AS i) p ON k = 1 + CAST(floor(i * (n - 1) / {POINTS - 1.0}) AS BIGINT)""")
def q_curve_points(spark, d):
    """Fifty evenly spaced points of each year's revenue curve over SKUs."""
    g = B.ventas(spark, d, channel=False, product=False).groupBy("Anio", "ProductoID").agg(F.sum("IngresosReales").alias("ing"))
    w = Window.partitionBy("Anio")
    r = g.withColumn("k", F.row_number().over(w.orderBy("ing", "ProductoID"))).withColumn("n", F.count(F.lit(1)).over(w))
    steps = F.transform(F.sequence(F.lit(0), F.lit(POINTS - 1)), lambda i: F.struct(i.alias("i"), (1 + F.floor(i * (F.col("n") - 1) / (POINTS - 1.0))).alias("at")))
    hits = F.filter(steps, lambda s: s["at"] == F.col("k"))
    return r.select("Anio", F.col("ing").cast("double").alias("Ingresos"), F.explode(hits).alias("s")).select("Anio", F.col("s.i").cast("int").alias("Punto"), "Ingresos")


@query("deflated_sales", with_ctes(B.ventas_sql(channel=False, product=False), """m AS (
  SELECT Anio, Mes, CAST(SUM(IngresosReales) AS DOUBLE) AS ing, CAST(SUM(IngresosReales) AS DOUBLE) / CAST(SUM(VolumenReal) AS DOUBLE) AS idx FROM ventas GROUP BY 1, 2)""") + """SELECT Anio, Mes,
  round(idx / (SELECT idx FROM m ORDER BY Anio, Mes LIMIT 1), 8) AS Indice, round(ing * (SELECT idx FROM m ORDER BY Anio, Mes LIMIT 1) / idx, 4) AS IngresosConstantes,
  round(idx - lag(idx) OVER (ORDER BY Anio, Mes), 8) AS CambioIndice FROM m""")
def q_deflated_sales(spark, d):
    """Revenue at the first month's unit price, the index as a product of monthly
    factors, and its first difference (one series of months)."""
    m = B.ventas(spark, d, channel=False, product=False).groupBy("Anio", "Mes").agg(
        F.sum("IngresosReales").cast("double").alias("ing"), (F.sum("IngresosReales").cast("double") / F.sum("VolumenReal").cast("double")).alias("idx"))
    m = m.withColumn("serie", F.lit(0)).withColumn("t", F.col("Anio") * 12 + F.col("Mes"))
    m = W.first_diff(m, ["serie"], "t", "idx", "cambio")
    factor = F.coalesce(F.col("idx") / F.lag("idx").over(Window.partitionBy("serie").orderBy("t")), F.lit(1.0))
    m = W.compound_index(m.withColumn("f", factor), ["serie"], "t", "f", "rel")
    return m.select("Anio", "Mes", F.round("rel", 8).alias("Indice"), F.round(F.col("ing") / F.col("rel"), 4).alias("IngresosConstantes"),
                    F.round("cambio", 8).alias("CambioIndice"))


def year_or_all(df: DataFrame, year_col: str, year: int) -> DataFrame:
    """Rows of the year; all rows if it has none."""
    have = df.agg(F.max((F.col(year_col) == year).cast("int"))).scalar()
    return df.filter((F.col(year_col) == year) | (F.coalesce(have, F.lit(0)) == 0))


@query("year_filter_fallback", """SELECT 1997 AS Pedido, COUNT(*) AS Filas, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS Importe FROM orders WHERE year(o_orderdate) = 1997
UNION ALL SELECT 2050, COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM orders""")
def q_year_filter_fallback(spark, d):
    """A year that the orders have, and one that they do not."""
    o = materialise(read(spark, d, "orders", "o_orderdate", "o_totalprice").groupBy(F.year("o_orderdate").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("s")))
    one = lambda y: year_or_all(o, "y", y).agg(F.lit(y).alias("Pedido"), F.sum("n").alias("Filas"), F.sum("s").cast("double").alias("Importe"))
    return one(1997).unionByName(one(2050))


@query("geo_rollup", """SELECT n_name AS FincaOrigen, round(avg(CAST(s_suppkey % 180 - 90 AS DOUBLE)), 8) AS Latitud, round(avg(CAST(s_suppkey * 7 % 360 - 180 AS DOUBLE)), 8) AS Longitud,
  CAST(COUNT(*) AS BIGINT) AS Puntos FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def q_geo_rollup(spark, d):
    """Mean position per farm; the suppliers' keys stand for coordinates."""
    s, n = read(spark, d, "supplier", "s_suppkey", "s_nationkey"), read(spark, d, "nation", "n_nationkey", "n_name")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)  # 25 rows
    return j.groupBy(F.col("n_name").alias("FincaOrigen")).agg(
        F.round(F.avg(F.col("s_suppkey") % 180 - 90), 8).alias("Latitud"), F.round(F.avg(F.col("s_suppkey") * 7 % 360 - 180), 8).alias("Longitud"),
        F.count(F.lit(1)).alias("Puntos"))


# ---------------------------------------------------------------------------
# Scoring portfolio of customers
# ---------------------------------------------------------------------------

# Score levels with their advice, and the health of the portfolio.
LEVELS = [(70, "RIESGO CRITICO"), (45, "RIESGO MODERADO"), (20, "RIESGO BAJO")]
LEVEL_ELSE = "SOLVENTE EXCELENTE"
PRESCRIPTION = {
    "RIESGO CRITICO": "EXIGIR PAGO CONTADO ANTICIPADO: Bloquear cuenta corriente y retener remito de despacho.",
    "RIESGO MODERADO": "REDUCIR PLAZO A 30 DIAS: Solicitar aval bancario o cheque de pago diferido endosable.",
    "RIESGO BAJO": "CONDICIONES ESTANDAR: Monitorear rotacion trimestral y otorgar descuento por pronto pago 5%.",
    "SOLVENTE EXCELENTE": "CLIENTE PREFERENCIAL: Autorizar linea de credito ampliada a 60 dias y bonificacion por volumen.",
}
HEALTH = [(0.15, "ALTO RIESGO"), (0.08, "ALERTA")]
HEALTH_ELSE = "CARTERA SANA"

_SCORE_SQL = f"""s AS (
  SELECT c_custkey AS ClienteID, c_mktsegment AS Segmento, COUNT(o_orderkey) AS pedidos, COALESCE(SUM(CAST(o_totalprice AS DECIMAL(12,2))), 0) AS volumen,
         100.0 * COUNT(o_orderkey) FILTER (WHERE o_orderstatus <> 'F') / greatest(COUNT(o_orderkey), 1) AS score,
         avg(30 * CAST(substr(o_orderpriority, 1, 1) AS INT)) AS plazo
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
l AS (SELECT *, CASE {' '.join(f"WHEN score >= {t} THEN '{n}'" for t, n in LEVELS)} ELSE '{LEVEL_ELSE}' END AS nivel FROM s)"""


def customer_scores(spark, d) -> DataFrame:
    """Score 0-100 of each customer: share of orders that are not settled."""
    c, o = read(spark, d, "customer", "c_custkey", "c_mktsegment"), read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    # sums per customer first, so one row each meets the customers
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("pedidos"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("volumen"),
                                     F.count_if(F.col("o_orderstatus") != "F").alias("abiertos"),
                                     F.avg(30 * F.substring("o_orderpriority", 1, 1).cast("int")).alias("plazo"))
    j = c.join(per, c.c_custkey == per.o_custkey, "left")
    score = 100.0 * F.coalesce("abiertos", F.lit(0)) / F.greatest(F.coalesce("pedidos", F.lit(0)), F.lit(1))
    level = F.when(F.col("score") >= LEVELS[0][0], LEVELS[0][1])
    for t, n in LEVELS[1:]:
        level = level.when(F.col("score") >= t, n)
    return (j.select(F.col("c_custkey").alias("ClienteID"), F.col("c_mktsegment").alias("Segmento"), F.coalesce("pedidos", F.lit(0)).alias("pedidos"),
                     F.coalesce(F.col("volumen"), F.lit(0)).alias("volumen"), score.alias("score"), "plazo").withColumn("nivel", level.otherwise(LEVEL_ELSE)))


@query("scoring_portfolio", with_ctes(_SCORE_SQL) + f"""SELECT Segmento, CAST(COUNT(*) AS BIGINT) AS Clientes, {', '.join(f"CAST(COUNT(*) FILTER (WHERE nivel = '{n}') AS BIGINT) AS n{k}" for k, (_, n) in enumerate(LEVELS))},
  CAST(COALESCE(SUM(volumen) FILTER (WHERE nivel = '{LEVELS[0][1]}'), 0) AS DOUBLE) AS VolumenCritico, round(avg(score), 8) AS ScorePromedio, round(avg(plazo), 8) AS PlazoPromedio,
  round(COUNT(*) FILTER (WHERE nivel = '{LEVELS[0][1]}') / COUNT(*), 10) AS ParteCritica,
  CASE {' '.join(f"WHEN COUNT(*) FILTER (WHERE nivel = '{LEVELS[0][1]}') / COUNT(*) > {t} THEN '{n}'" for t, n in HEALTH)} ELSE '{HEALTH_ELSE}' END AS Salud
FROM l GROUP BY Segmento""")
def q_scoring_portfolio(spark, d):
    """Per segment: customers by risk level, critical volume and share, mean score
    and term, and the health of the portfolio."""
    s = customer_scores(spark, d)
    critical = F.col("nivel") == LEVELS[0][1]
    share = F.count_if(critical) / F.count(F.lit(1))
    health = F.when(F.col("ParteCritica_") > HEALTH[0][0], HEALTH[0][1])
    for t, n in HEALTH[1:]:
        health = health.when(F.col("ParteCritica_") > t, n)
    g = s.groupBy("Segmento").agg(
        F.count(F.lit(1)).alias("Clientes"), *[F.count_if(F.col("nivel") == n).alias(f"n{k}") for k, (_, n) in enumerate(LEVELS)],
        F.coalesce(F.sum(F.when(critical, F.col("volumen"))), F.lit(0)).cast("double").alias("VolumenCritico"),
        F.round(F.avg("score"), 8).alias("ScorePromedio"), F.round(F.avg("plazo"), 8).alias("PlazoPromedio"), share.alias("ParteCritica_"))
    return g.withColumn("ParteCritica", F.round("ParteCritica_", 10)).withColumn("Salud", health.otherwise(HEALTH_ELSE)).drop("ParteCritica_")


@query("score_prescription", with_ctes(_SCORE_SQL) + f"""SELECT ClienteID, round(score, 8) AS Score, nivel AS Nivel, CASE nivel {' '.join(f"WHEN '{n}' THEN '{t}'" for n, t in PRESCRIPTION.items())} END AS Prescripcion FROM l""")
def q_score_prescription(spark, d):
    """Level and prescription of every customer's score."""
    text = F.create_map(*[F.lit(v) for kv in PRESCRIPTION.items() for v in kv])
    return customer_scores(spark, d).select("ClienteID", F.round("score", 8).alias("Score"), F.col("nivel").alias("Nivel"), text[F.col("nivel")].alias("Prescripcion"))
