"""The suite's star model over the test tables, and queries with slicers on dimension
columns, a second date role and totals at several levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import star as S
from ledgerlake.plans.model import div
from ledgerlake.registry import query, with_ctes
from ledgerlake.sources import bridge as B
from ledgerlake.sources.tables import read, small

_DAY = "CAST({} AS DATE)"


def _key(c: str) -> str:
    return B.datekey(_DAY.format(c))


RELATIONSHIPS = [
    S.Relationship("ventas", "DateKeyEmbarque", "Calendario", "DateKey"),
    S.Relationship("ventas", "DateKeyPedido", "Calendario", "DateKey", "pedido"),
    S.Relationship("ventas", "ProductoID", "Productos", "ProductoID"),
    S.Relationship("ventas", "ClienteID", "Clientes", "ClienteID"),
    S.Relationship("pedidos", "DateKeyPedido", "Calendario", "DateKey"),
    S.Relationship("pedidos", "DateKeyPedido", "Calendario", "DateKey", "pedido"),
    S.Relationship("pedidos", "ClienteID", "Clientes", "ClienteID"),
    S.Relationship("inventario", "DateKeyEmbarque", "Calendario", "DateKey"),
    S.Relationship("inventario", "ProductoID", "Productos", "ProductoID"),
    S.Relationship("gastos", "DateKey", "Calendario", "DateKey"),
    S.Relationship("gastos", "CentroCostoID", "CentrosCosto", "CentroCostoID"),
]

BASES = {
    "b_volumen": S.Base("ventas", "VolumenReal"), "b_ingresos": S.Base("ventas", "IngresosReales"), "b_costo": S.Base("ventas", "CostoReal"),
    "b_clientes": S.Base("ventas", "ClienteID", "distinct"), "b_pedidos_n": S.Base("pedidos", "PedidoID", "distinct"), "b_importe": S.Base("pedidos", "Importe"),
    "b_litros": S.Base("inventario", "Litros"), "b_opex": S.Base("gastos", "OPEXReal"),
    "b_ingresos_sel": S.Base("ventas", "IngresosReales", all_selected=True),
    "b_ingresos_todo": S.Base("ventas", "IngresosReales", ignores=frozenset({"Productos.Segmento", "Productos.Linea"})),
}


def star(spark, d) -> S.Star:
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "l_linestatus")
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_retailprice")
    e = F.expr
    ventas = (li.join(small(o.drop("o_totalprice"), d, "orders", 32), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(small(p.select("p_partkey", "p_retailprice"), d, "part", 24), F.col("l_partkey") == F.col("p_partkey"))
              .select(e(_key("l_shipdate")).alias("DateKeyEmbarque"), e(_key("o_orderdate")).alias("DateKeyPedido"), F.col("l_partkey").alias("ProductoID"),
                      F.col("o_custkey").alias("ClienteID"), e(B.VOLUME).alias("VolumenReal"), e(B.REVENUE).alias("IngresosReales"), e(B.COST).alias("CostoReal")))
    pedidos = o.select(e(_key("o_orderdate")).alias("DateKeyPedido"), F.col("o_custkey").alias("ClienteID"), F.col("o_orderkey").alias("PedidoID"),
                       e(f"CAST(o_totalprice AS {B.MONEY})").alias("Importe"))
    inventario = li.where("l_linestatus = 'O'").select(e(_key("l_shipdate")).alias("DateKeyEmbarque"), F.col("l_partkey").alias("ProductoID"), e(B.VOLUME).alias("Litros"))
    gastos = B.gastos_operativos(spark, d).select("DateKey", "CentroCostoID", "OPEXReal")
    # one row per day between the first order and the last shipment
    span = o.agg(F.min(e(_DAY.format("o_orderdate"))).alias("a")).crossJoin(li.agg(F.max(e(_DAY.format("l_shipdate"))).alias("b")))
    days = span.select(F.explode(e("sequence(trunc(a, 'MM'), greatest(a, b))")).alias("Fecha"))
    calendario = F.broadcast(days.select(e(B.datekey("Fecha")).alias("DateKey"), F.year("Fecha").alias("Anio"), F.quarter("Fecha").alias("Trimestre"), F.month("Fecha").alias("Mes")))
    productos = small(p.select(F.col("p_partkey").alias("ProductoID"), F.col("p_brand").alias("Linea"), F.col("p_type").alias("Segmento")), d, "part", 64)
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    n = read(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read(spark, d, "region", "r_regionkey", "r_name")
    n = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows
    clientes = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("ClienteID"), F.col("c_mktsegment").alias("CanalVenta"), F.col("n_name").alias("Pais"), F.col("r_name").alias("Region"))
    centros = n.select(F.col("n_name").alias("CentroCostoID"), F.col("r_name").alias("Area"))
    return S.Star({"ventas": ventas, "pedidos": pedidos, "inventario": inventario, "gastos": gastos},
                  {"Calendario": calendario, "Productos": productos, "Clientes": small(clientes, d, "customer", 80), "CentrosCosto": F.broadcast(centros)},
                  RELATIONSHIPS, BASES)


_CTES = [f"""f_ventas AS (
  SELECT {_key('l_shipdate')} AS DateKeyEmbarque, {_key('o_orderdate')} AS DateKeyPedido, l_partkey AS ProductoID, o_custkey AS ClienteID,
         {B.VOLUME} AS VolumenReal, {B.REVENUE} AS IngresosReales, {B.COST} AS CostoReal
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""",
         f"""f_pedidos AS (
  SELECT {_key('o_orderdate')} AS DateKeyPedido, o_custkey AS ClienteID, o_orderkey AS PedidoID, CAST(o_totalprice AS {B.MONEY}) AS Importe FROM orders)""",
         f"""f_inventario AS (
  SELECT {_key('l_shipdate')} AS DateKeyEmbarque, l_partkey AS ProductoID, {B.VOLUME} AS Litros FROM lineitem WHERE l_linestatus = 'O')""",
         B.GASTOS_SQL, f"""d_calendario AS (
  SELECT DISTINCT {B.datekey('f')} AS DateKey, year(f) AS Anio, quarter(f) AS Trimestre, month(f) AS Mes
  FROM (SELECT CAST(l_shipdate AS DATE) AS f FROM lineitem UNION SELECT CAST(o_orderdate AS DATE) FROM orders
        UNION SELECT date_trunc('month', CAST(l_shipdate AS DATE))::DATE FROM lineitem UNION SELECT date_trunc('month', CAST(o_orderdate AS DATE))::DATE FROM orders) x)""",
         "d_productos AS (SELECT p_partkey AS ProductoID, p_brand AS Linea, p_type AS Segmento FROM part)",
         """d_clientes AS (
  SELECT c_custkey AS ClienteID, c_mktsegment AS CanalVenta, n_name AS Pais, r_name AS Region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
         "d_centros AS (SELECT n_name AS CentroCostoID, r_name AS Area FROM nation JOIN region ON n_regionkey = r_regionkey)"]


def star_sql(measures, by, where=None, levels=None) -> str:
    return with_ctes(*_CTES) + S.evaluate_sql(
        {"ventas": "f_ventas", "pedidos": "f_pedidos", "inventario": "f_inventario", "gastos": "gastos"},
        {"Calendario": "d_calendario", "Productos": "d_productos", "Clientes": "d_clientes", "CentrosCosto": "d_centros"}, RELATIONSHIPS, BASES, {}, measures, by, where, levels)


_SEGMENT = {"Productos.Segmento": ["ECONOMY", "PROMO"], "Calendario.Trimestre": [1, 2]}
SLICED = [("Volumen", "b_volumen"), ("Ingresos", "b_ingresos"), ("MargenPct", "round(" + div("b_ingresos - b_costo", "b_ingresos") + ", 8)"), ("PrecioMedio", "round(" + div("b_ingresos", "b_volumen") + ", 6)"),
          ("StockLitros", "b_litros"), ("OPEX", "b_opex"), ("Pedidos", "b_pedidos_n"), ("IngresosSinSegmento", "b_ingresos_todo"), ("ParteSegmento", "round(" + div("b_ingresos", "b_ingresos_todo") + ", 8)")]


@query("star_slicers", star_sql(SLICED, ["Calendario.Anio", "Calendario.Trimestre"], _SEGMENT))
def q_star_slicers(spark, d):
    """Slicers on segment and quarter: the quarter reaches every fact, the segment those with products; orders and expenses
    know no product and stay whole; one sum ignores the segment."""
    return S.evaluate(star(spark, d), SLICED, ["Calendario.Anio", "Calendario.Trimestre"], _SEGMENT)


ROLES = [("Ingresos", "b_ingresos"), ("Volumen", "b_volumen"), ("Importe", "b_importe"), ("Pedidos", "b_pedidos_n")]
_REGION = {"Clientes.Region": ["EUROPE", "ASIA"]}


@query("star_role_key", star_sql(ROLES, ["Calendario@pedido.Anio", "Clientes.CanalVenta"], _REGION))
def q_star_role_key(spark, d):
    """By year of the order (role of the calendar) in place of the shipment, and channel, for two regions."""
    return S.evaluate(star(spark, d), ROLES, ["Calendario@pedido.Anio", "Clientes.CanalVenta"], _REGION)


TOTALS = [("Ingresos", "b_ingresos"), ("MargenPct", "round(" + div("b_ingresos - b_costo", "b_ingresos") + ", 8)"), ("Clientes", "b_clientes"),
          ("IngresoPorCliente", "round(" + div("b_ingresos", "b_clientes") + ", 8)"), ("ParteSeleccion", "round(" + div("b_ingresos", "b_ingresos_sel") + ", 10)"),
          ("StockLitros", "b_litros"), ("OPEX", "b_opex")]
_LEVELS = [["Calendario.Anio", "Productos.Linea"], ["Calendario.Anio"], ["Productos.Linea"], []]
_CHANNELS = {"Productos.Segmento": ["ECONOMY", "STANDARD", "SMALL"], "Clientes.CanalVenta": ["BUILDING", "MACHINERY"]}


@query("star_totals", star_sql(TOTALS, ["Calendario.Anio", "Productos.Linea"], _CHANNELS, _LEVELS))
def q_star_totals(spark, d):
    """Year and line, year, line and grand total from one cube per fact: distinct customers and ratios are evaluated again at
    each level, the share is of all that is selected."""
    return S.evaluate(star(spark, d), TOTALS, ["Calendario.Anio", "Productos.Linea"], _CHANNELS, _LEVELS)
