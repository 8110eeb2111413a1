"""Budget built from the prior year (``budget_prior_year``).

Base year: the budget equals the own actuals.  Later years: same month,
product and cost centre of the previous year times (1 + volume drift).
Price and cost anchors start at the base-year unit values and are
compounded each year by the inflation known when the budget was made (the
previous year's December-on-December change of the unit-price index) times
(1 + drift).  Noise terms of the source are off (deterministic).

The result is the full grid of observed months x products x cost centres (the
month list is exploded per product and cost centre, no cross join); cells
without a prior-year sale have volume 0.  ``product`` names the grain: the line
(default) or the SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources import bridge as B


def actual_cells(ventas: DataFrame, product: str = "Linea") -> DataFrame:
    return ventas.groupBy("MesDateKey", "AnioMes", "Anio", "Mes", F.col(product).alias("ProductoID"),
                          "CentroCostoID").agg(
        F.sum("VolumenReal").alias("VolumenReal"), F.sum("IngresosReales").alias("IngresosReales"),
        F.sum("CostoReal").alias("CostoReal"))


def inflation_assumption(cells: DataFrame) -> DataFrame:
    """Per year: inflation used to index that year's budget.

    Index = monthly unit price (revenue / volume); realised(y) = Dec(y) /
    Dec(y-1) - 1.  First year 0; second year uses its own realised value;
    later years the previous listed year's, falling back to their own, else 0.
    The tables here have one row per year (bounded)."""
    idx = cells.groupBy("Anio", "Mes").agg(
        (F.sum("IngresosReales").cast("double") / F.sum("VolumenReal").cast("double")).alias("idx"))
    dec = idx.filter(F.col("Mes") == 12).select("Anio", "idx")
    prev = dec.select((F.col("Anio") + 1).alias("Anio"), F.col("idx").alias("idx_prev"))
    realised = dec.join(prev, "Anio").select("Anio", (F.col("idx") / F.col("idx_prev") - 1).alias("r"))
    years = cells.select("Anio").distinct()
    w = Window.orderBy("Anio")
    y = years.withColumn("i", F.row_number().over(w)).withColumn("prev_y", F.lag("Anio").over(w))
    r_own = realised.select(F.col("Anio"), F.col("r").alias("r_own"))
    r_prev = realised.select(F.col("Anio").alias("prev_y"), F.col("r").alias("r_prev"))
    y = y.join(r_own, "Anio", "left").join(r_prev, "prev_y", "left")
    infl = (F.when(F.col("i") == 1, F.lit(0.0))
             .when(F.col("i") == 2, F.coalesce("r_own", F.lit(0.0)))
             .otherwise(F.coalesce("r_prev", "r_own", F.lit(0.0))))
    return y.select("Anio", "i", infl.alias("inflacion"))


def budget_prior_year(ventas: DataFrame, vol_drift: float = 0.0, price_drift: float = 0.0,
                      cost_drift: float = 0.0, write: bool = True, product: str = "Linea") -> DataFrame:
    cells = actual_cells(ventas, product)
    if write:
        # the cell aggregate (months x lines x cost centres, bounded by the
        # dimensions) feeds six branches below: write it once to the shared
        # checkpoint folder instead of re-running the sales join per branch
        cells = materialise(cells)
    # one row per year, so the yearly factors are folded here and enter as literals
    years = sorted(inflation_assumption(cells).collect(), key=lambda r: r.Anio)
    fp = fc = 1.0
    factors = []
    for r in years:
        if r.i > 1:
            fp, fc = fp * (1 + r.inflacion) * (1 + price_drift), fc * (1 + r.inflacion) * (1 + cost_drift)
        factors.append((r.Anio, fp, fc))
    base = years[0].Anio if years else None
    is_base = F.col("Anio") == F.lit(base)
    of_year = lambda k: F.element_at(F.map_from_arrays(F.array(*[F.lit(f[0]) for f in factors]), F.array(*[F.lit(f[k]) for f in factors])), F.col("Anio"))
    # base-year unit anchors per product (one row per product)
    anchors = cells.filter(is_base).groupBy("ProductoID").agg(
        F.sum("IngresosReales").alias("_r"), F.sum("CostoReal").alias("_c"), F.sum("VolumenReal").alias("_v"))
    anchors = anchors.select(
        "ProductoID",
        F.when(F.col("_v") > 0, F.col("_r").cast("double") / F.col("_v").cast("double")).alias("p0"),
        F.when(F.col("_v") > 0, F.col("_c").cast("double") / F.col("_v").cast("double")).alias("c0"))
    # the grid: every observed month (a short list) for every product and cost centre
    months = cells.select(F.struct("MesDateKey", "AnioMes", "Anio", "Mes").alias("m")).agg(F.collect_set("m")).scalar()
    centres = cells.agg(F.collect_set("CentroCostoID")).scalar()
    grid = (cells.select("ProductoID").distinct().withColumn("months", months).withColumn("centres", centres)
            .select("ProductoID", F.explode("centres").alias("CentroCostoID"), "months")
            .select("ProductoID", "CentroCostoID", F.inline("months")))
    base_cells = cells.filter(is_base).select(
        "Anio", "Mes", "ProductoID", "CentroCostoID", F.round(F.col("VolumenReal")).cast("long").alias("_v"))
    shifted = cells.select(
        (F.col("Anio") + 1).alias("Anio"), "Mes", "ProductoID", "CentroCostoID",
        F.greatest(F.lit(0), F.round(F.col("VolumenReal").cast("double") * (1 + vol_drift))).cast("long").alias("_v"))
    b = grid.join(base_cells.unionByName(shifted), ["Anio", "Mes", "ProductoID", "CentroCostoID"], "left").withColumn(
        "VolumenPresupuestado", F.coalesce("_v", F.lit(0).cast("long"))).drop("_v")
    b = b.join(anchors, "ProductoID", "left")
    px = F.round(F.col("p0") * (of_year(1) if factors else F.lit(None)), 2).cast("decimal(18,2)")
    cs = F.round(F.col("c0") * (of_year(2) if factors else F.lit(None)), 2).cast("decimal(18,2)")
    vol = F.col("VolumenPresupuestado").cast("decimal(18,0)")
    return b.select(
        F.col("MesDateKey").alias("DateKey"), "AnioMes", "Anio", "Mes", "ProductoID", "CentroCostoID",
        "VolumenPresupuestado", px.alias("PrecioPresupuestadoUnit"), cs.alias("CostoEstandarUnit"),
    ).withColumn("IngresosPresupuestados", vol * F.col("PrecioPresupuestadoUnit")
    ).withColumn("CostoPresupuestado", vol * F.col("CostoEstandarUnit")
    ).withColumn("MargenBrutoPresupuestado", F.col("IngresosPresupuestados") - F.col("CostoPresupuestado"))


def budget_sql(vol_drift: float = 0.0, price_drift: float = 0.0, cost_drift: float = 0.0, product: str = "Linea") -> str:
    return f"""cells AS (
  SELECT MesDateKey, AnioMes, Anio, Mes, {product} AS ProductoID, CentroCostoID,
         SUM(VolumenReal) AS VolumenReal, SUM(IngresosReales) AS IngresosReales, SUM(CostoReal) AS CostoReal
  FROM ventas GROUP BY 1, 2, 3, 4, 5, 6),
idx AS (SELECT Anio, Mes, CAST(SUM(IngresosReales) AS DOUBLE) / CAST(SUM(VolumenReal) AS DOUBLE) AS idx
        FROM cells GROUP BY 1, 2),
realised AS (SELECT a.Anio, a.idx / b.idx - 1 AS r FROM idx a JOIN idx b ON a.Anio = b.Anio + 1
             WHERE a.Mes = 12 AND b.Mes = 12),
yrs AS (SELECT Anio, ROW_NUMBER() OVER (ORDER BY Anio) AS i, LAG(Anio) OVER (ORDER BY Anio) AS prev_y
        FROM (SELECT DISTINCT Anio FROM cells) t),
infl AS (SELECT y.Anio, y.i,
           CASE WHEN y.i = 1 THEN 0.0 WHEN y.i = 2 THEN COALESCE(ro.r, 0.0)
                ELSE COALESCE(rp.r, ro.r, 0.0) END AS inflacion
         FROM yrs y LEFT JOIN realised ro ON ro.Anio = y.Anio LEFT JOIN realised rp ON rp.Anio = y.prev_y),
fac AS (SELECT Anio,
           product(CASE WHEN i = 1 THEN 1.0 ELSE (1 + inflacion) * (1 + {price_drift}) END)
             OVER (ORDER BY Anio ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
           product(CASE WHEN i = 1 THEN 1.0 ELSE (1 + inflacion) * (1 + {cost_drift}) END)
             OVER (ORDER BY Anio ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fc
         FROM infl),
base_year AS (SELECT Anio AS base FROM infl WHERE i = 1),
anchors AS (SELECT ProductoID,
           CASE WHEN SUM(VolumenReal) > 0 THEN CAST(SUM(IngresosReales) AS DOUBLE) / CAST(SUM(VolumenReal) AS DOUBLE) END AS p0,
           CASE WHEN SUM(VolumenReal) > 0 THEN CAST(SUM(CostoReal) AS DOUBLE) / CAST(SUM(VolumenReal) AS DOUBLE) END AS c0
         FROM cells WHERE Anio = (SELECT base FROM base_year) GROUP BY ProductoID),
months AS (SELECT DISTINCT MesDateKey, AnioMes, Anio, Mes FROM cells),
bcells AS (
  SELECT m.MesDateKey, m.AnioMes, m.Anio, m.Mes, p.ProductoID, k.CentroCostoID,
         COALESCE(CASE WHEN m.Anio = (SELECT base FROM base_year) THEN CAST(ROUND(own.VolumenReal) AS BIGINT)
                       ELSE CAST(greatest(0, ROUND(CAST(prev.VolumenReal AS DOUBLE) * (1 + {vol_drift}))) AS BIGINT) END, 0) AS VolumenPresupuestado
  FROM months m CROSS JOIN (SELECT DISTINCT ProductoID FROM cells) p CROSS JOIN (SELECT DISTINCT CentroCostoID FROM cells) k
  LEFT JOIN cells own ON own.MesDateKey = m.MesDateKey AND own.ProductoID = p.ProductoID AND own.CentroCostoID = k.CentroCostoID
  LEFT JOIN cells prev ON prev.Anio = m.Anio - 1 AND prev.Mes = m.Mes AND prev.ProductoID = p.ProductoID AND prev.CentroCostoID = k.CentroCostoID),
presupuesto0 AS (
  SELECT b.MesDateKey AS DateKey, b.AnioMes, b.Anio, b.Mes, b.ProductoID, b.CentroCostoID, b.VolumenPresupuestado,
         CAST(ROUND(a.p0 * f.fp, 2) AS DECIMAL(18,2)) AS PrecioPresupuestadoUnit,
         CAST(ROUND(a.c0 * f.fc, 2) AS DECIMAL(18,2)) AS CostoEstandarUnit
  FROM bcells b JOIN fac f ON b.Anio = f.Anio LEFT JOIN anchors a ON a.ProductoID = b.ProductoID),
presupuesto AS (
  SELECT *, CAST(VolumenPresupuestado AS DECIMAL(18,0)) * PrecioPresupuestadoUnit AS IngresosPresupuestados,
         CAST(VolumenPresupuestado AS DECIMAL(18,0)) * CostoEstandarUnit AS CostoPresupuestado,
         CAST(VolumenPresupuestado AS DECIMAL(18,0)) * PrecioPresupuestadoUnit
           - CAST(VolumenPresupuestado AS DECIMAL(18,0)) * CostoEstandarUnit AS MargenBrutoPresupuestado
  FROM presupuesto0)"""


def presupuesto(spark, d: str) -> DataFrame:
    return budget_prior_year(B.ventas(spark, d))


@query("budget_prior_year", with_ctes(B.ventas_sql(), budget_sql()) + """SELECT DateKey, AnioMes, ProductoID,
  CentroCostoID, VolumenPresupuestado, CAST(PrecioPresupuestadoUnit AS DOUBLE) AS PrecioPresupuestadoUnit,
  CAST(CostoEstandarUnit AS DOUBLE) AS CostoEstandarUnit,
  CAST(IngresosPresupuestados AS DOUBLE) AS IngresosPresupuestados,
  CAST(CostoPresupuestado AS DOUBLE) AS CostoPresupuestado,
  CAST(MargenBrutoPresupuestado AS DOUBLE) AS MargenBrutoPresupuestado
FROM presupuesto""")
def q_budget_prior_year(spark, d):
    b = presupuesto(spark, d)
    return b.select("DateKey", "AnioMes", "ProductoID", "CentroCostoID", "VolumenPresupuestado",
                    *[F.col(c).cast("double").alias(c) for c in
                      ("PrecioPresupuestadoUnit", "CostoEstandarUnit", "IngresosPresupuestados",
                       "CostoPresupuestado", "MargenBrutoPresupuestado")])


@query("budget_by_sku_year", with_ctes(B.ventas_sql(), budget_sql(product="ProductoID")) + """SELECT ProductoID, CentroCostoID, Anio,
  CAST(COUNT(*) AS BIGINT) AS Meses, CAST(SUM(VolumenPresupuestado) AS BIGINT) AS VolumenPresupuestado, CAST(SUM(IngresosPresupuestados) AS DOUBLE) AS IngresosPresupuestados
FROM presupuesto GROUP BY 1, 2, 3""")
def q_budget_by_sku_year(spark, d):
    """The same budget at SKU grain (dense months x SKUs x cost centres), by year."""
    b = budget_prior_year(B.ventas(spark, d), product="ProductoID")
    return b.groupBy("ProductoID", "CentroCostoID", "Anio").agg(
        F.count(F.lit(1)).alias("Meses"), F.sum("VolumenPresupuestado").alias("VolumenPresupuestado"),
        F.sum("IngresosPresupuestados").cast("double").alias("IngresosPresupuestados"))


@query("inflation_assumption", with_ctes(B.ventas_sql(), budget_sql()) + """SELECT Anio, inflacion FROM infl""")
def q_inflation_assumption(spark, d):
    return inflation_assumption(actual_cells(B.ventas(spark, d))).select("Anio", "inflacion")


@query("cohort_year_summary", with_ctes(B.ventas_sql(), budget_sql()) + """, v AS (
  SELECT Anio, SUM(IngresosReales) AS ing, SUM(VolumenReal) AS vol, SUM(MargenBrutoReal) AS mb FROM ventas GROUP BY Anio),
p AS (SELECT Anio, SUM(IngresosPresupuestados) AS ing_p, SUM(VolumenPresupuestado) AS vol_p,
             SUM(MargenBrutoPresupuestado) AS mb_p FROM presupuesto GROUP BY Anio),
y AS (SELECT CAST(v.Anio AS VARCHAR) AS Anio, v.ing, v.vol, v.mb, p.ing_p, p.vol_p, p.mb_p FROM v JOIN p ON v.Anio = p.Anio),
t AS (SELECT * FROM y UNION ALL
      SELECT 'TOTAL', SUM(ing), SUM(vol), SUM(mb), SUM(ing_p), SUM(vol_p), SUM(mb_p) FROM y)
SELECT Anio, round(CAST(ing AS DOUBLE) / 1e9, 6) AS Ventas_B, round(CAST(ing_p AS DOUBLE) / 1e9, 6) AS Ppto_B,
  round(CAST(ing AS DOUBLE) / CAST(ing_p AS DOUBLE) * 100, 2) AS Cumpl_Ing_Pct,
  round(CAST(vol AS DOUBLE) / CAST(vol_p AS DOUBLE) * 100, 2) AS Cumpl_Vol_Pct,
  round(CAST(mb AS DOUBLE) / CAST(ing AS DOUBLE) * 100, 2) AS Margen_Real_Pct,
  round(CAST(mb_p AS DOUBLE) / CAST(ing_p AS DOUBLE) * 100, 2) AS Margen_Ppto_Pct
FROM t""")
def q_cohort_year_summary(spark, d):
    """Yearly actual vs budget plus the all-years total row (rollup)."""
    v = B.ventas(spark, d)
    p = presupuesto(spark, d)
    va = v.groupBy("Anio").agg(F.sum("IngresosReales").alias("ing"), F.sum("VolumenReal").alias("vol"),
                               F.sum("MargenBrutoReal").alias("mb"))
    pa = p.groupBy("Anio").agg(F.sum("IngresosPresupuestados").alias("ing_p"),
                               F.sum("VolumenPresupuestado").alias("vol_p"),
                               F.sum("MargenBrutoPresupuestado").alias("mb_p"))
    y = va.join(pa, "Anio")
    t = y.rollup("Anio").agg(*[F.sum(c).alias(c) for c in ("ing", "vol", "mb", "ing_p", "vol_p", "mb_p")])
    dd = lambda c: F.col(c).cast("double")
    return t.select(
        F.coalesce(F.col("Anio").cast("string"), F.lit("TOTAL")).alias("Anio"),
        F.round(dd("ing") / 1e9, 6).alias("Ventas_B"), F.round(dd("ing_p") / 1e9, 6).alias("Ppto_B"),
        F.round(dd("ing") / dd("ing_p") * 100, 2).alias("Cumpl_Ing_Pct"),
        F.round(dd("vol") / dd("vol_p") * 100, 2).alias("Cumpl_Vol_Pct"),
        F.round(dd("mb") / dd("ing") * 100, 2).alias("Margen_Real_Pct"),
        F.round(dd("mb_p") / dd("ing_p") * 100, 2).alias("Margen_Ppto_Pct"))
