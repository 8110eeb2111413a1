"""Star schema of the analytics suite, derived from the driver's test tables.

Each star table has a DataFrame builder and the same mapping as a SQL CTE
(used by the DuckDB oracles).  The column expressions are kept as shared SQL
text so both sides compute bit-identical values: money is carried as DECIMAL
so sums are exact whatever the partitioning, and only final ratios are
doubles.

Mapping (fact <- test tables):
  Ventas            lineitem |x| orders |x| customer |x| part
  Productos         part (SKU = part, Linea = brand, Segmento = type)
  PresupuestoVentas operators.budget.budget_prior_year over Ventas
                    (grain month x Linea x sales cost centre)
  GastosOperativos  lineitem |x| supplier |x| nation, month x nation x return flag
  CapitalTrabajo    orders (receivable/payable by status) + lineitem (stock)
  ProduccionPlanta  lineitem |x| part |x| supplier |x| nation
  InventarioGuarda  lineitem |x| orders |x| part, month x brand x line status
  MercadoCambiario  daily unit price and discount of lineitem
  flows             events: purchase = +4 x value, other = -value
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.tables import read, small

# ---------------------------------------------------------------------------
# Shared expression text (valid Spark SQL and DuckDB SQL)
# ---------------------------------------------------------------------------

def datekey(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + dayofmonth({d}))"


def month_key(d: str) -> str:
    """yyyymm01 integer key of the month (monthly facts use day 01)."""
    return f"(year({d}) * 10000 + month({d}) * 100 + 1)"


def anio_mes(d: str) -> str:
    return f"concat(CAST(year({d}) AS STRING), '-', lpad(CAST(month({d}) AS STRING), 2, '0'))"


MONEY = "DECIMAL(12,2)"
RATE = "DECIMAL(4,2)"

REVENUE = f"CAST(l_extendedprice AS {MONEY}) * (1 - CAST(l_discount AS {RATE}))"
GROSS = f"CAST(l_extendedprice AS {MONEY})"
VOLUME = f"CAST(l_quantity AS {MONEY})"
COST = f"CAST(l_quantity AS {MONEY}) * CAST(p_retailprice AS {MONEY})"
OPEX_REAL = f"CAST(l_extendedprice AS {MONEY}) * CAST(l_tax AS {RATE})"
OPEX_PLAN = f"CAST(l_extendedprice AS {MONEY}) * CAST(l_discount AS {RATE})"
LITRES = f"CAST(l_extendedprice AS {MONEY}) * (0.62 + CAST(l_discount AS {RATE}))"

# Fixed values of the bridge: the export channel and the two sales cost centres.
EXPORT_SEGMENT = "MACHINERY"
CC_EXPORT = "CC-203"
CC_DOMESTIC = "CC-202"
SALES_CC = f"CASE WHEN c_mktsegment = '{EXPORT_SEGMENT}' THEN '{CC_EXPORT}' ELSE '{CC_DOMESTIC}' END"
SANITARY = ("CASE l_returnflag WHEN 'N' THEN 'Optima' WHEN 'A' THEN 'Buena' "
            "ELSE 'Regular' END")
# The four vessels of the aging inventory (by line status and line number).
VESSELS = ("Piletas de Acero Inoxidable", "Barricas de Roble Frances", "Barricas de Roble Americano", "Botellero en Estiba Climatizada")
VESSEL = (f"CASE WHEN l_linestatus = 'O' THEN '{VESSELS[0]}' WHEN l_linenumber % 3 = 0 THEN '{VESSELS[1]}' "
          f"WHEN l_linenumber % 3 = 1 THEN '{VESSELS[2]}' ELSE '{VESSELS[3]}' END")
ACCOUNT_NAME = "CASE l_returnflag WHEN 'A' THEN 'Account A' WHEN 'N' THEN 'Account N' ELSE 'Account R' END"


def _e(expr: str):
    return F.expr(expr)


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------

def productos(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice").select(
        F.col("p_partkey").alias("ProductoID"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 5, "0")).alias("SKU"),
        F.col("p_name").alias("Descripcion"),
        F.col("p_brand").alias("Linea"),
        F.col("p_type").alias("Segmento"),
        F.col("p_retailprice").alias("CostoEstandarUnit"),
    )


PRODUCTOS_SQL = """productos AS (
  SELECT p_partkey AS ProductoID,
         concat('SKU-', lpad(CAST(p_partkey AS STRING), 5, '0')) AS SKU,
         p_name AS Descripcion, p_brand AS Linea, p_type AS Segmento,
         p_retailprice AS CostoEstandarUnit
  FROM part)"""


def centros_costo(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read(spark, d, "region", "r_regionkey", "r_name")
    # nation and region are fixed-size dimensions (25 / 5 rows)
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("CentroCostoID"), F.col("n_name").alias("NombreCentroCosto"),
        F.col("r_name").alias("Area"), F.col("n_nationkey"))


# ---------------------------------------------------------------------------
# Sales fact
# ---------------------------------------------------------------------------

def ventas(spark: SparkSession, d: str, channel: bool = True, product: bool = True) -> DataFrame:
    """Sales at line grain.  ``channel`` adds the orders/customer joins,
    ``product`` the part join (needed for cost and product attributes)."""
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_shipdate")
    df = li
    if channel:
        o = read(spark, d, "orders", "o_orderkey", "o_custkey")
        c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
        oc = o.join(small(c, d, "customer", 32), o.o_custkey == c.c_custkey).select("o_orderkey", "c_mktsegment")
        df = df.join(small(oc, d, "orders", 32), df.l_orderkey == oc.o_orderkey)
    if product:
        p = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_retailprice")
        df = df.join(small(p, d, "part", 96), df.l_partkey == p.p_partkey)
    fecha = "CAST(l_shipdate AS DATE)"
    cols = [
        F.col("l_orderkey").alias("TransaccionID"),
        _e(fecha).alias("Fecha"),
        _e(datekey(fecha)).alias("DateKey"),
        _e(month_key(fecha)).alias("MesDateKey"),
        _e(anio_mes(fecha)).alias("AnioMes"),
        _e(f"year({fecha})").alias("Anio"),
        _e(f"month({fecha})").alias("Mes"),
        F.col("l_partkey").alias("ProductoID"),
        _e(VOLUME).alias("VolumenReal"),
        _e(REVENUE).alias("IngresosReales"),
        _e(GROSS).alias("FacturacionBruta"),
    ]
    if channel:
        cols += [F.col("c_mktsegment").alias("CanalVenta"), _e(SALES_CC).alias("CentroCostoID")]
    if product:
        cols += [F.col("p_brand").alias("Linea"), F.col("p_type").alias("Segmento"),
                 _e(COST).alias("CostoReal"), _e(f"{REVENUE} - {COST}").alias("MargenBrutoReal")]
    return df.select(*cols)


def ventas_sql(channel: bool = True, product: bool = True) -> str:
    fecha = "CAST(l_shipdate AS DATE)"
    cols = [
        "l_orderkey AS TransaccionID", f"{fecha} AS Fecha", f"{datekey(fecha)} AS DateKey",
        f"{month_key(fecha)} AS MesDateKey", f"{anio_mes(fecha)} AS AnioMes",
        f"year({fecha}) AS Anio", f"month({fecha}) AS Mes", "l_partkey AS ProductoID",
        f"{VOLUME} AS VolumenReal", f"{REVENUE} AS IngresosReales", f"{GROSS} AS FacturacionBruta",
    ]
    joins = ""
    if channel:
        cols += ["c_mktsegment AS CanalVenta", f"{SALES_CC} AS CentroCostoID"]
        joins += (" JOIN orders ON l_orderkey = o_orderkey"
                  " JOIN customer ON o_custkey = c_custkey")
    if product:
        cols += ["p_brand AS Linea", "p_type AS Segmento", f"{COST} AS CostoReal",
                 f"{REVENUE} - {COST} AS MargenBrutoReal"]
        joins += " JOIN part ON l_partkey = p_partkey"
    return "ventas AS (\n  SELECT " + ",\n         ".join(cols) + f"\n  FROM lineitem{joins})"


# ---------------------------------------------------------------------------
# Operating expenses: month x cost centre (supplier nation) x account (flag)
# ---------------------------------------------------------------------------

def opex_lines(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_shipdate")
    s = read(spark, d, "supplier", "s_suppkey", "s_nationkey")
    n = read(spark, d, "nation", "n_nationkey", "n_name")
    sn = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")
    fecha = "CAST(l_shipdate AS DATE)"
    return li.join(small(sn, d, "supplier", 40), li.l_suppkey == sn.s_suppkey).select(
        _e(month_key(fecha)).alias("DateKey"), _e(anio_mes(fecha)).alias("AnioMes"),
        F.col("n_name").alias("CentroCostoID"), F.col("l_returnflag").alias("CuentaID"),
        _e(OPEX_PLAN).alias("OPEXPresupuestado"), _e(OPEX_REAL).alias("OPEXReal"))


def gastos_operativos(spark: SparkSession, d: str) -> DataFrame:
    """`group_to_grain`: duplicates summed to the unique key, then deviations."""
    g = opex_lines(spark, d).groupBy("DateKey", "AnioMes", "CentroCostoID", "CuentaID").agg(
        F.sum("OPEXPresupuestado").alias("OPEXPresupuestado"), F.sum("OPEXReal").alias("OPEXReal"))
    return g.withColumn("DesvioOPEX", F.col("OPEXReal") - F.col("OPEXPresupuestado"))


GASTOS_SQL = f"""opex_lines AS (
  SELECT {month_key('CAST(l_shipdate AS DATE)')} AS DateKey, {anio_mes('CAST(l_shipdate AS DATE)')} AS AnioMes,
         n_name AS CentroCostoID, l_returnflag AS CuentaID,
         {OPEX_PLAN} AS OPEXPresupuestado, {OPEX_REAL} AS OPEXReal
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
gastos AS (
  SELECT DateKey, AnioMes, CentroCostoID, CuentaID,
         SUM(OPEXPresupuestado) AS OPEXPresupuestado, SUM(OPEXReal) AS OPEXReal,
         SUM(OPEXReal) - SUM(OPEXPresupuestado) AS DesvioOPEX
  FROM opex_lines GROUP BY DateKey, AnioMes, CentroCostoID, CuentaID)"""


def plan_cuentas(spark: SparkSession, d: str) -> DataFrame:
    return (read(spark, d, "lineitem", "l_returnflag").distinct()
            .select(F.col("l_returnflag").alias("CuentaID"), _e(ACCOUNT_NAME).alias("NombreCuenta")))


# ---------------------------------------------------------------------------
# Working capital: one row per month
# ---------------------------------------------------------------------------

def capital_trabajo(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders", "o_orderstatus", "o_totalprice", "o_orderdate")
    od = "CAST(o_orderdate AS DATE)"
    arap = o.groupBy(_e(month_key(od)).alias("DateKey")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "O", _e(f"CAST(o_totalprice AS {MONEY})"))).alias("CuentasPorCobrar"),
        F.sum(F.when(F.col("o_orderstatus") == "P", _e(f"CAST(o_totalprice AS {MONEY})"))).alias("CuentasPorPagar"))
    li = read(spark, d, "lineitem", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_linestatus", "l_shipdate")
    p = read(spark, d, "part", "p_partkey", "p_retailprice")
    sd = "CAST(l_shipdate AS DATE)"
    sales = li.join(small(p, d, "part", 32), li.l_partkey == p.p_partkey).groupBy(
        _e(month_key(sd)).alias("DateKey"), _e(anio_mes(sd)).alias("AnioMes")).agg(
        F.sum(_e(REVENUE)).alias("Ingresos"), F.sum(_e(COST)).alias("Costo"),
        F.sum(F.when(F.col("l_linestatus") == "O", _e(COST))).alias("Inventario"))
    j = sales.join(arap, "DateKey", "left")
    # amounts stay DECIMAL (exact sums downstream); day ratios are rounded
    # to cents and carried as DECIMAL too
    ar = F.coalesce(F.col("CuentasPorCobrar"), F.lit(0).cast(MONEY))
    ap = F.coalesce(F.col("CuentasPorPagar"), F.lit(0).cast(MONEY))
    inv = F.coalesce(F.col("Inventario"), F.lit(0).cast(MONEY))
    rev = F.col("Ingresos").cast("double")
    cost = F.col("Costo").cast("double")
    days = lambda num, den: F.when(den > 0, F.round(num.cast("double") / den * 30, 2)).otherwise(
        F.lit(0.0)).cast("decimal(12,2)")
    return j.select(
        "DateKey", "AnioMes", ar.alias("CuentasPorCobrar"), ap.alias("CuentasPorPagar"),
        inv.alias("Inventario"), days(ar, rev).alias("DSO_DiasCobro"), days(inv, cost).alias("DIO_DiasInventario"),
        days(ap, cost).alias("DPO_DiasPago"),
    ).withColumn("CicloConversionEfectivo_CCC",
                 F.col("DSO_DiasCobro") + F.col("DIO_DiasInventario") - F.col("DPO_DiasPago")
    ).withColumn("NecesidadOperativaFondos_NOF",
                 F.col("CuentasPorCobrar") + F.col("Inventario") - F.col("CuentasPorPagar"))


CAPITAL_SQL = f"""arap AS (
  SELECT {month_key('CAST(o_orderdate AS DATE)')} AS DateKey,
         SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS {MONEY}) END) AS CuentasPorCobrar,
         SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS {MONEY}) END) AS CuentasPorPagar
  FROM orders GROUP BY 1),
sales_m AS (
  SELECT {month_key('CAST(l_shipdate AS DATE)')} AS DateKey, {anio_mes('CAST(l_shipdate AS DATE)')} AS AnioMes,
         SUM({REVENUE}) AS Ingresos, SUM({COST}) AS Costo,
         SUM(CASE WHEN l_linestatus = 'O' THEN {COST} END) AS Inventario
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
capital0 AS (
  SELECT s.DateKey, s.AnioMes,
         COALESCE(CuentasPorCobrar, 0) AS CuentasPorCobrar,
         COALESCE(CuentasPorPagar, 0) AS CuentasPorPagar,
         COALESCE(Inventario, 0) AS Inventario,
         CAST(Ingresos AS DOUBLE) AS rev, CAST(Costo AS DOUBLE) AS cost
  FROM sales_m s LEFT JOIN arap a ON s.DateKey = a.DateKey),
capital1 AS (
  SELECT DateKey, AnioMes, CuentasPorCobrar, CuentasPorPagar, Inventario,
         CAST(CASE WHEN rev > 0 THEN round(CAST(CuentasPorCobrar AS DOUBLE) / rev * 30, 2) ELSE 0.0 END AS DECIMAL(12,2)) AS DSO_DiasCobro,
         CAST(CASE WHEN cost > 0 THEN round(CAST(Inventario AS DOUBLE) / cost * 30, 2) ELSE 0.0 END AS DECIMAL(12,2)) AS DIO_DiasInventario,
         CAST(CASE WHEN cost > 0 THEN round(CAST(CuentasPorPagar AS DOUBLE) / cost * 30, 2) ELSE 0.0 END AS DECIMAL(12,2)) AS DPO_DiasPago
  FROM capital0),
capital AS (
  SELECT *, DSO_DiasCobro + DIO_DiasInventario - DPO_DiasPago AS CicloConversionEfectivo_CCC,
         CuentasPorCobrar + Inventario - CuentasPorPagar AS NecesidadOperativaFondos_NOF
  FROM capital1)"""


# ---------------------------------------------------------------------------
# Plant intake (one delivery note per line)
# ---------------------------------------------------------------------------

def produccion(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    p = read(spark, d, "part", "p_partkey", "p_type")
    s = read(spark, d, "supplier", "s_suppkey", "s_nationkey")
    n = read(spark, d, "nation", "n_nationkey", "n_name")
    sn = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")
    fecha = "CAST(l_shipdate AS DATE)"
    return (li.join(small(p, d, "part", 64), li.l_partkey == p.p_partkey)
            .join(small(sn, d, "supplier", 40), li.l_suppkey == sn.s_suppkey).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("RemitoID"),
        _e(datekey(fecha)).alias("DateKey"), _e(month_key(fecha)).alias("MesDateKey"),
        F.col("n_name").alias("FincaOrigen"), F.col("p_type").alias("VariedadUva"),
        _e(GROSS).alias("KilosEntrada"), _e(VOLUME).alias("GradosBrix"),
        _e(LITRES).alias("LitrosMostoObtenido"), _e(SANITARY).alias("CalificacionSanitaria")))


PRODUCCION_SQL = f"""produccion AS (
  SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS RemitoID,
         {datekey('CAST(l_shipdate AS DATE)')} AS DateKey, {month_key('CAST(l_shipdate AS DATE)')} AS MesDateKey,
         n_name AS FincaOrigen, p_type AS VariedadUva,
         {GROSS} AS KilosEntrada, {VOLUME} AS GradosBrix, {LITRES} AS LitrosMostoObtenido,
         {SANITARY} AS CalificacionSanitaria
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey)"""


# ---------------------------------------------------------------------------
# Aging inventory: month x brand x vessel (line status)
# ---------------------------------------------------------------------------

def inventario(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
              "l_tax", "l_linestatus", "l_linenumber", "l_shipdate")
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    p = read(spark, d, "part", "p_partkey", "p_brand")
    fecha = "CAST(l_shipdate AS DATE)"
    j = (li.join(small(o, d, "orders", 32), li.l_orderkey == o.o_orderkey)
         .join(small(p, d, "part", 40), li.l_partkey == p.p_partkey))
    return j.groupBy(_e(month_key(fecha)).alias("DateKey"), F.col("p_brand").alias("ProductoID"),
                     _e(VESSEL).alias("TipoVasija")).agg(
        F.sum(_e(VOLUME)).alias("Litros"), F.sum(_e(GROSS)).alias("ValorInventario"),
        (F.sum(_e(f"CAST(l_tax AS {RATE})")).cast("double") / F.count(F.lit(1))).alias("MermaPct"),
        F.avg(_e("datediff(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE))")).alias("DIODias"))


INVENTARIO_SQL = f"""inventario AS (
  SELECT {month_key('CAST(l_shipdate AS DATE)')} AS DateKey, p_brand AS ProductoID, {VESSEL} AS TipoVasija,
         SUM({VOLUME}) AS Litros, SUM({GROSS}) AS ValorInventario,
         CAST(SUM(CAST(l_tax AS {RATE})) AS DOUBLE) / COUNT(*) AS MermaPct,
         AVG(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS DIODias
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""


# ---------------------------------------------------------------------------
# FX market: daily spot (unit price) and domestic rate (mean discount)
# ---------------------------------------------------------------------------

def mercado(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    fecha = "CAST(l_shipdate AS DATE)"
    g = li.groupBy(_e(fecha).alias("Fecha")).agg(
        F.sum(_e(GROSS)).alias("_gross"), F.sum(_e(VOLUME)).alias("_vol"),
        F.sum(_e(f"CAST(l_discount AS {RATE})")).alias("_disc"), F.count(F.lit(1)).alias("_n"))
    return g.select(
        "Fecha", _e(datekey("Fecha")).alias("DateKey"),
        (F.col("_gross").cast("double") / F.col("_vol").cast("double")).alias("TipoCambioSpot"),
        (F.col("_disc").cast("double") / F.col("_n")).alias("TasaDomesticaTNA"))


MERCADO_SQL = f"""mercado AS (
  SELECT Fecha, {datekey('Fecha')} AS DateKey,
         CAST(_gross AS DOUBLE) / CAST(_vol AS DOUBLE) AS TipoCambioSpot,
         CAST(_disc AS DOUBLE) / _n AS TasaDomesticaTNA
  FROM (SELECT CAST(l_shipdate AS DATE) AS Fecha, SUM({GROSS}) AS _gross, SUM({VOLUME}) AS _vol,
               SUM(CAST(l_discount AS {RATE})) AS _disc, COUNT(*) AS _n
        FROM lineitem GROUP BY 1) m)"""


# ---------------------------------------------------------------------------
# Treasury flows from events
# ---------------------------------------------------------------------------

FLOW = "CASE WHEN event_type = 'purchase' THEN 4 * CAST(value AS DECIMAL(12,2)) ELSE -CAST(value AS DECIMAL(12,2)) END"


def flujos(spark: SparkSession, d: str, per_user: bool = False) -> DataFrame:
    """Daily net cash flow; one series, or one per user (``per_user``)."""
    ev = read(spark, d, "events", "ts", "user_id", "event_type", "value")
    keys = [F.col("user_id").alias("CuentaID")] if per_user else [F.lit(0).cast("long").alias("CuentaID")]
    return ev.groupBy(*keys, _e("CAST(ts AS DATE)").alias("Fecha")).agg(
        F.sum(_e(FLOW)).cast("double").alias("FlujoNetoDiario"))


def flujos_sql(per_user: bool = False) -> str:
    key = "user_id" if per_user else "CAST(0 AS BIGINT)"
    return f"""flujos AS (
  SELECT {key} AS CuentaID, CAST(ts AS DATE) AS Fecha, CAST(SUM({FLOW}) AS DOUBLE) AS FlujoNetoDiario
  FROM events GROUP BY 1, 2)"""


# ---------------------------------------------------------------------------
# Export receivables: orders of the export segment
# ---------------------------------------------------------------------------

RECEIVABLE = ("CASE WHEN o_orderstatus = 'F' THEN 'Cobrado' ELSE 'Pendiente' END", "30 * CAST(substr(o_orderpriority, 1, 1) AS INT)")


def cobranzas(spark: SparkSession, d: str) -> DataFrame:
    """One row per export order: amount, whether it is paid, term in days (30 for
    each step of the order's priority)."""
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment").filter(F.col("c_mktsegment") == EXPORT_SEGMENT)
    j = o.join(small(c, d, "customer", 32), o.o_custkey == c.c_custkey)
    return j.select(F.col("o_orderkey").alias("CobranzaID"), F.year("o_orderdate").alias("Anio"), _e(f"CAST(o_totalprice AS {MONEY})").alias("ImporteFOB"),
                    _e(RECEIVABLE[0]).alias("EstadoCobranza"), _e(RECEIVABLE[1]).alias("PlazoDiasCobro"))


def cobranzas_sql() -> str:
    return f"""cobranzas AS (
  SELECT o_orderkey AS CobranzaID, year(o_orderdate) AS Anio, CAST(o_totalprice AS {MONEY}) AS ImporteFOB, {RECEIVABLE[0]} AS EstadoCobranza,
         {RECEIVABLE[1]} AS PlazoDiasCobro
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{EXPORT_SEGMENT}')"""
