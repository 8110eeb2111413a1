"""Commercial jobs: Pareto by product x channel, ABC classes, sales KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.bands import (PARETO_SQL_DEFAULT, PARETO_SQL_RULES, band,
                                        band_sql)
from ledgerlake.operators.windows import ranked_running_total
from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources import bridge as B


def pareto_commercial(ventas: DataFrame, productos: DataFrame) -> DataFrame:
    """Product x channel Pareto: rank, share, cumulative share, class.

    Aggregate first (one row per product x channel), attach product
    attributes, then rank/cumulate with the bucketed global window."""
    rc = ventas.groupBy("ProductoID", "CanalVenta").agg(
        F.sum("VolumenReal").alias("VolumenTotal"),
        F.sum("IngresosReales").alias("IngresosTotales"),
        F.sum("MargenBrutoReal").alias("MargenBrutoTotal"))
    rc = rc.join(productos.select("ProductoID", "SKU", "Descripcion", "Linea"), "ProductoID")
    r = ranked_running_total(rc, "IngresosTotales", tiebreak=["ProductoID", "CanalVenta"],
                             rank_col="RankingComercial")
    tot = F.col("_total").cast("double")
    out = r.select(
        "RankingComercial", "ProductoID", "SKU", "Descripcion", "Linea", "CanalVenta",
        F.col("VolumenTotal").cast("double").alias("VolumenTotal"),
        F.round("IngresosTotales", 2).cast("double").alias("IngresosTotales"),
        F.round("MargenBrutoTotal", 2).cast("double").alias("MargenBrutoTotal"),
        F.round(F.col("IngresosTotales").cast("double") / tot * 100.0, 2).alias("ParticipacionVentasPct"),
        F.round(F.col("_cum").cast("double") / tot * 100.0, 2).alias("PctAcumuladoVentas"))
    return out.withColumn("ClasificacionPareto",
                          band("PctAcumuladoVentas", PARETO_SQL_RULES, PARETO_SQL_DEFAULT))


PARETO_SQL = with_ctes(B.ventas_sql(), B.PRODUCTOS_SQL, """par AS (
  SELECT ProductoID, CanalVenta, SUM(VolumenReal) AS vol, SUM(IngresosReales) AS ing, SUM(MargenBrutoReal) AS mb
  FROM ventas GROUP BY ALL)""", """ahead AS (
  SELECT x.ProductoID, x.CanalVenta, SUM(y.ing) AS upto,
         COUNT(*) FILTER (WHERE y.ing > x.ing OR (y.ProductoID, y.CanalVenta) <= (x.ProductoID, x.CanalVenta)) AS place
  FROM par x JOIN par y ON y.ing >= x.ing GROUP BY ALL)""") + f"""SELECT *,
  {band_sql('PctAcumuladoVentas', PARETO_SQL_RULES, PARETO_SQL_DEFAULT)} AS ClasificacionPareto
FROM (
  SELECT place AS RankingComercial, p.ProductoID, p.SKU, p.Descripcion, p.Linea, CanalVenta, vol::DOUBLE AS VolumenTotal,
         round(ing, 2)::DOUBLE AS IngresosTotales, round(mb, 2)::DOUBLE AS MargenBrutoTotal,
         round(100.0 * (ing::DOUBLE / whole::DOUBLE), 2) AS ParticipacionVentasPct,
         round(100.0 * (upto::DOUBLE / whole::DOUBLE), 2) AS PctAcumuladoVentas
  FROM par JOIN ahead USING (ProductoID, CanalVenta) JOIN productos p USING (ProductoID), (SELECT SUM(ing) AS whole FROM par)) t"""


@query("pareto_commercial", PARETO_SQL)
def q_pareto_commercial(spark, d):
    return pareto_commercial(B.ventas(spark, d), B.productos(spark, d))


# ---------------------------------------------------------------------------
# ABC classes at SKU grain and the class-A measures
# ---------------------------------------------------------------------------
from ledgerlake.functions.bands import ABC_ADVICE, ABC_ADVICE_DEFAULT, ABC_DEFAULT, ABC_RULES  # noqa: E402
from ledgerlake.functions.clean import map_values  # noqa: E402
from ledgerlake.plans import budget as BU  # noqa: E402
from ledgerlake.plans import model as M  # noqa: E402

def abc_classes(ventas: DataFrame) -> DataFrame:
    """Per SKU: revenue, margin %, share of the revenue of all SKUs ranking at
    or above it (ties included), class A/B/C by 75 % / 92 % and the advice."""
    s = ventas.groupBy("ProductoID").agg(F.sum("IngresosReales").alias("ing"),
                                         F.sum("MargenBrutoReal").alias("mb"))
    r = ranked_running_total(s, "ing", tiebreak=["ProductoID"])
    share = F.col("_cum").cast("double") / F.col("_total").cast("double")
    cls = band(share, ABC_RULES, ABC_DEFAULT)
    return r.select("ProductoID", F.col("ing").cast("double").alias("IngresosReales"),
                    F.round(F.col("mb").cast("double") / F.col("ing").cast("double"), 10).alias("MargenBrutoPct"),
                    F.round(share, 10).alias("VentasAcumuladasPct"),
                    F.when(F.col("ing").isNull(), None).otherwise(cls).alias("ClasificacionABC")
                    ).withColumn("RecomendacionABC", map_values("ClasificacionABC", ABC_ADVICE, ABC_ADVICE_DEFAULT))


_ABC_SQL = with_ctes(B.ventas_sql(channel=False), """s AS (
  SELECT ProductoID, SUM(IngresosReales) AS ing, SUM(MargenBrutoReal) AS mb FROM ventas GROUP BY 1)""",
    """c AS (SELECT *, CAST(SUM(ing) OVER (ORDER BY ing DESC) AS DOUBLE) / CAST(SUM(ing) OVER () AS DOUBLE) AS share FROM s)""",
    f"""abc AS (SELECT ProductoID, CAST(ing AS DOUBLE) AS IngresosReales,
  round(CAST(mb AS DOUBLE) / CAST(ing AS DOUBLE), 10) AS MargenBrutoPct, round(share, 10) AS VentasAcumuladasPct,
  CASE WHEN ing IS NULL THEN NULL WHEN share <= 0.75 THEN 'Clase A' WHEN share <= 0.92 THEN 'Clase B' ELSE 'Clase C' END AS ClasificacionABC
  FROM c)""")


@query("abc_classes", _ABC_SQL + """SELECT *, CASE ClasificacionABC WHEN 'Clase A' THEN 'Prioridad: Proteger stock y margen'
  WHEN 'Clase B' THEN 'Estrategia: Estimular volumen Horeca' WHEN 'Clase C' THEN 'Accion: Ajustar precio o descontinuar'
  ELSE 'Revision de cartera' END AS RecomendacionABC FROM abc""")
def q_abc_classes(spark, d):
    return abc_classes(B.ventas(spark, d, channel=False))


@query("sales_kpis_class_a", _ABC_SQL + """
SELECT (SELECT COUNT(*) FROM abc WHERE ClasificacionABC = 'Clase A') AS SKUsClaseA,
  (SELECT SUM(IngresosReales) FROM abc WHERE ClasificacionABC = 'Clase A') AS IngresosClaseA,
  round((SELECT SUM(CAST(mb AS DOUBLE)) FROM s WHERE ProductoID IN (SELECT ProductoID FROM abc WHERE ClasificacionABC = 'Clase A'))
        / (SELECT SUM(IngresosReales) FROM abc WHERE ClasificacionABC = 'Clase A'), 10) AS MargenPromedioClaseA,
  COUNT(DISTINCT TransaccionID) AS CantidadPedidos,
  round(CAST(SUM(IngresosReales) AS DOUBLE) / COUNT(DISTINCT TransaccionID), 6) AS TicketPromedio
FROM ventas""")
def q_sales_kpis_class_a(spark, d):
    """Class-A count, revenue and margin (classes computed first, then
    filtered), orders (distinct transactions) and average ticket.  The sales are
    read once: one aggregate holds the sums per product and a row per order."""
    v = B.ventas(spark, d, channel=False)
    g = materialise(v.groupingSets([[F.col("ProductoID")], [F.col("TransaccionID")]], F.col("ProductoID"), F.col("TransaccionID")).agg(
        F.grouping("ProductoID").alias("es_pedido"), F.sum("IngresosReales").alias("IngresosReales"),
        F.sum("MargenBrutoReal").alias("MargenBrutoReal")))
    a = abc_classes(g.filter("es_pedido = 0").select("ProductoID", "IngresosReales", "MargenBrutoReal"))
    classes = a.join(g.filter("es_pedido = 0").select("ProductoID", F.col("MargenBrutoReal").cast("double").alias("mb")), "ProductoID")
    top = classes.filter("ClasificacionABC = 'Clase A'").agg(
        F.count(F.lit(1)).alias("SKUsClaseA"), F.sum("IngresosReales").alias("IngresosClaseA"), F.sum("mb").alias("mb"))
    orders = g.filter("es_pedido = 1").agg(F.count(F.lit(1)).alias("CantidadPedidos"), F.sum("IngresosReales").cast("double").alias("ing"))
    # one row on either side
    return top.crossJoin(orders).select(
        "SKUsClaseA", "IngresosClaseA", F.round(F.col("mb") / F.col("IngresosClaseA"), 10).alias("MargenPromedioClaseA"),
        "CantidadPedidos", F.round(F.col("ing") / F.col("CantidadPedidos"), 6).alias("TicketPromedio"))


# ---------------------------------------------------------------------------
# Budget allocated over channels
# ---------------------------------------------------------------------------

def budget_by_channel(ventas: DataFrame, budget: DataFrame, export_channel: str = B.EXPORT_SEGMENT) -> DataFrame:
    """Per year and channel: the domestic budget split over the domestic
    channels in proportion to their actual sales, plus the export cost
    centre's own budget on the export channel; attainment and quota gap."""
    real = ventas.groupBy("Anio", "CanalVenta").agg(F.sum("IngresosReales").alias("ing"),
                                                    F.sum("VolumenReal").alias("vol"))
    dom = real.filter(F.col("CanalVenta") != export_channel).groupBy("Anio").agg(
        F.sum("ing").alias("ing_dom"), F.sum("vol").alias("vol_dom"))
    bud = budget.groupBy("Anio").agg(
        F.sum(F.when(F.col("CentroCostoID") == B.CC_DOMESTIC, F.col("IngresosPresupuestados"))).alias("bi_dom"),
        F.sum(F.when(F.col("CentroCostoID") == B.CC_EXPORT, F.col("IngresosPresupuestados"))).alias("bi_exp"),
        F.sum(F.when(F.col("CentroCostoID") == B.CC_DOMESTIC, F.col("VolumenPresupuestado"))).alias("bv_dom"),
        F.sum(F.when(F.col("CentroCostoID") == B.CC_EXPORT, F.col("VolumenPresupuestado"))).alias("bv_exp"))
    j = real.join(dom, "Anio", "left").join(bud, "Anio", "left")
    is_exp = F.col("CanalVenta") == export_channel
    d = lambda c: F.col(c).cast("double")
    share_i = F.when(is_exp | (F.coalesce(d("ing_dom"), F.lit(0.0)) == 0), F.lit(0.0)).otherwise(d("ing") / d("ing_dom"))
    share_v = F.when(is_exp | (F.coalesce(d("vol_dom"), F.lit(0.0)) == 0), F.lit(0.0)).otherwise(d("vol") / d("vol_dom"))
    bi = F.coalesce(d("bi_dom"), F.lit(0.0)) * share_i + F.when(is_exp, F.coalesce(d("bi_exp"), F.lit(0.0))).otherwise(0.0)
    bv = F.coalesce(d("bv_dom"), F.lit(0.0)) * share_v + F.when(is_exp, F.coalesce(d("bv_exp"), F.lit(0.0))).otherwise(0.0)
    return j.select("Anio", "CanalVenta", d("ing").alias("IngresosReales"), bi.alias("_plan"), F.round(bi, 4).alias("IngresosPresupuesto"),
                    F.round(bv, 4).alias("VolumenPresupuesto"),
                    F.round(F.when(bi == 0, 0.0).otherwise(d("ing") / bi), 10).alias("CumplimientoPresupuestoPct"),
                    F.round(F.when(bi == 0, 0.0).otherwise((d("ing") - bi) / bi), 10).alias("DesvioCuotaPct"))


@query("budget_allocation", with_ctes(B.ventas_sql(), BU.budget_sql(), f"""r AS (
  SELECT Anio, CanalVenta, SUM(IngresosReales) AS ing, SUM(VolumenReal) AS vol FROM ventas GROUP BY 1, 2)""",
    f"""dm AS (SELECT Anio, SUM(ing) AS ing_dom, SUM(vol) AS vol_dom FROM r WHERE CanalVenta <> '{B.EXPORT_SEGMENT}' GROUP BY 1)""",
    f"""bu AS (SELECT Anio,
      SUM(CASE WHEN CentroCostoID = '{B.CC_DOMESTIC}' THEN IngresosPresupuestados END) AS bi_dom,
      SUM(CASE WHEN CentroCostoID = '{B.CC_EXPORT}' THEN IngresosPresupuestados END) AS bi_exp,
      SUM(CASE WHEN CentroCostoID = '{B.CC_DOMESTIC}' THEN VolumenPresupuestado END) AS bv_dom,
      SUM(CASE WHEN CentroCostoID = '{B.CC_EXPORT}' THEN VolumenPresupuestado END) AS bv_exp FROM presupuesto GROUP BY 1)""",
    f"""a AS (SELECT r.Anio, r.CanalVenta, CAST(ing AS DOUBLE) AS ing,
      COALESCE(CAST(bi_dom AS DOUBLE), 0.0) * (CASE WHEN CanalVenta = '{B.EXPORT_SEGMENT}' OR COALESCE(CAST(ing_dom AS DOUBLE), 0.0) = 0 THEN 0.0 ELSE CAST(ing AS DOUBLE) / CAST(ing_dom AS DOUBLE) END)
        + CASE WHEN CanalVenta = '{B.EXPORT_SEGMENT}' THEN COALESCE(CAST(bi_exp AS DOUBLE), 0.0) ELSE 0.0 END AS bi,
      COALESCE(CAST(bv_dom AS DOUBLE), 0.0) * (CASE WHEN CanalVenta = '{B.EXPORT_SEGMENT}' OR COALESCE(CAST(vol_dom AS DOUBLE), 0.0) = 0 THEN 0.0 ELSE CAST(vol AS DOUBLE) / CAST(vol_dom AS DOUBLE) END)
        + CASE WHEN CanalVenta = '{B.EXPORT_SEGMENT}' THEN COALESCE(CAST(bv_exp AS DOUBLE), 0.0) ELSE 0.0 END AS bv
    FROM r LEFT JOIN dm ON r.Anio = dm.Anio LEFT JOIN bu ON r.Anio = bu.Anio)""") + """SELECT Anio, CanalVenta,
  ing AS IngresosReales, round(bi, 4) AS IngresosPresupuesto, round(bv, 4) AS VolumenPresupuesto,
  round(CASE WHEN bi = 0 THEN 0.0 ELSE ing / bi END, 10) AS CumplimientoPresupuestoPct,
  round(CASE WHEN bi = 0 THEN 0.0 ELSE (ing - bi) / bi END, 10) AS DesvioCuotaPct
FROM a""")
def q_budget_allocation(spark, d):
    v = M.sales_cube(spark, d)
    return budget_by_channel(v, BU.budget_prior_year(v, write=False)).drop("_plan")


# ---------------------------------------------------------------------------
# Prices against the list, and the budget of a channel selection
# ---------------------------------------------------------------------------

# Limits, labels and rules of the price deviation.
PRICE_BANDS = [("<", -0.05, "Critico"), ("<", 0.0, "Bajo Plan")]
PRICE_BAND_ELSE = "En Plan"
PRICE_RULES = [("<", -0.05, "Suspender bonificaciones y auditar acuerdos comerciales"), ("<", 0.0, "Revisar escala de volumen por canal y defender margen")]
PRICE_RULE_ELSE = "Defender precio de lista y capitalizar pricing power"


def price_vs_list(ventas: DataFrame, budget: DataFrame, by: list[str]) -> DataFrame:
    """Average price against the budget's list price; gross billing is volume at
    list price per product, added up over products; deductions are what is missing
    to it.  Both facts are summed to ``by`` and product first, so sums are joined."""
    k = [*by, "Linea"]
    v = ventas.groupBy(*k).agg(F.sum("VolumenReal").cast("double").alias("q"), F.sum("IngresosReales").cast("double").alias("r"),
                               F.sum("CostoReal").cast("double").alias("c"))
    b = budget.withColumnRenamed("ProductoID", "Linea").groupBy(*k).agg(
        F.sum("VolumenPresupuestado").cast("double").alias("qp"), F.sum("IngresosPresupuestados").cast("double").alias("rp"))
    ratio = lambda a, c: F.when(F.coalesce(c, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(a / c)
    j = v.join(b, k, "full_outer").withColumn("gross", F.coalesce("q", F.lit(0.0)) * ratio(F.col("rp"), F.col("qp")))
    g = j.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("q", "r", "c", "qp", "rp", "gross")])
    price, listed = ratio(F.col("r"), F.col("q")), ratio(F.col("rp"), F.col("qp"))
    dev = ratio(price - listed, listed)
    return g.select(*by, F.round(price, 8).alias("PrecioPromedioReal"), F.round(listed, 8).alias("PrecioLista"), F.round(price - listed, 8).alias("DesvioPrecio"),
                    F.round(ratio(listed - price, listed), 8).alias("DescuentoComercialPct"), F.round("gross", 3).alias("FacturacionBruta"),
                    F.round(F.col("gross") - F.col("r"), 3).alias("Deducciones"), F.round(ratio(F.col("gross") - F.col("r"), F.col("gross")), 8).alias("DeduccionesPct"),
                    F.round(F.col("r") - F.col("c"), 4).alias("MargenContribucion"), F.round(dev, 8).alias("DesvioPrecioPct"),
                    band(dev, PRICE_BANDS, PRICE_BAND_ELSE).alias("SemaforoVariacionPrecio"), band(dev, PRICE_RULES, PRICE_RULE_ELSE).alias("ReglaDecisionPrecio"))


@query("price_vs_list", with_ctes(B.ventas_sql(), BU.budget_sql(), """rows_ AS (
  SELECT Anio, Linea AS l, VolumenReal AS q, IngresosReales AS r, CostoReal AS c, NULL AS qp, NULL AS rp FROM ventas
  UNION ALL SELECT Anio, ProductoID, NULL, NULL, NULL, VolumenPresupuestado, IngresosPresupuestados FROM presupuesto)""", """per AS (
  SELECT Anio, l, SUM(q)::DOUBLE AS q, SUM(r)::DOUBLE AS r, SUM(c)::DOUBLE AS c, SUM(qp)::DOUBLE AS qp, SUM(rp)::DOUBLE AS rp FROM rows_ GROUP BY 1, 2)""", """y AS (
  SELECT Anio, SUM(q) AS q, SUM(r) AS r, SUM(c) AS c, SUM(rp) / SUM(qp) AS lst, SUM(r) / SUM(q) AS px,
         SUM(CASE WHEN COALESCE(qp, 0) = 0 THEN 0 ELSE COALESCE(q, 0) * rp / qp END) AS gross FROM per GROUP BY Anio)""") + f"""SELECT Anio, round(px, 8) AS PrecioPromedioReal,
  round(lst, 8) AS PrecioLista, round(px - lst, 8) AS DesvioPrecio, round(1 - px / lst, 8) AS DescuentoComercialPct, round(gross, 3) AS FacturacionBruta,
  round(gross - r, 3) AS Deducciones, round(1 - r / gross, 8) AS DeduccionesPct, round(r - c, 4) AS MargenContribucion, round(px / lst - 1, 8) AS DesvioPrecioPct,
  {band_sql('(px / lst - 1)', PRICE_BANDS, PRICE_BAND_ELSE)} AS SemaforoVariacionPrecio, {band_sql('(px / lst - 1)', PRICE_RULES, PRICE_RULE_ELSE)} AS ReglaDecisionPrecio
FROM y""")
def q_price_vs_list(spark, d):
    v = M.sales_cube(spark, d)
    return price_vs_list(v, BU.budget_prior_year(v, write=False), ["Anio"])


SELECTED = ["BUILDING", "MACHINERY"]


@query("com_channel_selection", with_ctes(B.ventas_sql(), BU.budget_sql()) + f"""SELECT y.Anio, CAST(sel AS DOUBLE) AS IngresosReales,
  round(bd * CAST(dom_sel AS DOUBLE) / CAST(dom AS DOUBLE) + bx, 4) AS IngresosPresupuesto, round(CAST(sel AS DOUBLE) / (bd * CAST(dom_sel AS DOUBLE) / CAST(dom AS DOUBLE) + bx), 10) AS CumplimientoPct
FROM (SELECT Anio, SUM(IngresosReales) FILTER (WHERE CanalVenta IN {tuple(SELECTED)}) AS sel,
             SUM(IngresosReales) FILTER (WHERE CanalVenta IN {tuple(SELECTED)} AND CanalVenta <> '{B.EXPORT_SEGMENT}') AS dom_sel,
             SUM(IngresosReales) FILTER (WHERE CanalVenta <> '{B.EXPORT_SEGMENT}') AS dom FROM ventas GROUP BY Anio) y
JOIN (SELECT Anio, CAST(SUM(IngresosPresupuestados) FILTER (WHERE CentroCostoID = '{B.CC_DOMESTIC}') AS DOUBLE) AS bd,
             CAST(SUM(IngresosPresupuestados) FILTER (WHERE CentroCostoID = '{B.CC_EXPORT}') AS DOUBLE) AS bx FROM presupuesto GROUP BY Anio) b USING (Anio)""")
def q_com_channel_selection(spark, d):
    """Budget of a channel selection: the shares come from sales that ignore the
    channel filter, intersected with the selection again; the export plan counts
    if its channel is selected."""
    v = M.sales_cube(spark, d)
    parts = budget_by_channel(v, BU.budget_prior_year(v, write=False)).filter(F.col("CanalVenta").isin(SELECTED))
    g = parts.groupBy("Anio").agg(F.sum("IngresosReales").alias("IngresosReales"), F.sum("_plan").alias("p"))
    return g.select("Anio", "IngresosReales", F.round("p", 4).alias("IngresosPresupuesto"), F.round(F.col("IngresosReales") / F.col("p"), 10).alias("CumplimientoPct"))
