"""Data checks (DDL constraints re-aimed as dataset checks) and the small
relational primitives of the inventory, each as a registered query."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import checks as K
from ledgerlake.operators import etl as E
from ledgerlake.operators.windows import exact_quantiles, ffill_bfill, top_n_ties
from ledgerlake.registry import query, with_ctes
from ledgerlake.sources import bridge as B
from ledgerlake.sources.tables import read


@query("integrity_checks", with_ctes(B.GASTOS_SQL, B.ventas_sql(channel=False)) + """SELECT * FROM (
  SELECT 'lineitem' AS tabla, 'not_null' AS regla,
         CAST(SUM(CASE WHEN l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_shipdate IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS violaciones FROM lineitem
  UNION ALL SELECT 'lineitem', 'check_range_quantity', CAST(SUM(CASE WHEN l_quantity > 0 THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'lineitem', 'check_range_discount', CAST(SUM(CASE WHEN l_discount BETWEEN 0 AND 0.10 THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'lineitem', 'check_in_set_returnflag', CAST(SUM(CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'lineitem', 'foreign_key_l_partkey', COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 'lineitem', 'foreign_key_l_orderkey', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'customer', 'check_length_segment', CAST(SUM(CASE WHEN length(c_mktsegment) <= 10 THEN 0 ELSE 1 END) AS BIGINT) FROM customer
  UNION ALL SELECT 'gastos', 'primary_key', COUNT(*) FROM (SELECT DateKey, CentroCostoID, CuentaID FROM gastos GROUP BY 1, 2, 3 HAVING COUNT(*) > 1) d
  UNION ALL SELECT 'gastos', 'check_range_opex', CAST(SUM(CASE WHEN OPEXReal >= 0 AND OPEXPresupuestado >= 0 THEN 0 ELSE 1 END) AS BIGINT) FROM gastos
  UNION ALL SELECT 'gastos', 'grid_complete', CAST(COUNT(DISTINCT DateKey) * COUNT(DISTINCT CentroCostoID) * COUNT(DISTINCT CuentaID) - COUNT(*) AS BIGINT) FROM gastos
  UNION ALL SELECT 'ventas', 'series_no_gaps', COUNT(*) FROM (
      SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m
      FROM (SELECT CAST(date_trunc('month', Fecha) AS DATE) AS m FROM ventas) s) f
    WHERE m NOT IN (SELECT DISTINCT CAST(date_trunc('month', Fecha) AS DATE) FROM ventas)
  UNION ALL SELECT 'ventas', 'check_not_flat', CASE WHEN stddev_samp(y) > 0 THEN 0 ELSE 1 END FROM (
      SELECT MesDateKey, CAST(SUM(IngresosReales) AS DOUBLE) AS y FROM ventas GROUP BY 1) g
) c""")
def q_integrity_checks(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag",
              "l_shipdate")
    part = read(spark, d, "part", "p_partkey")
    orders = read(spark, d, "orders", "o_orderkey")
    cust = read(spark, d, "customer", "c_mktsegment")
    g = B.gastos_operativos(spark, d)
    v = B.ventas(spark, d, channel=False)
    parts = [
        K.violations(li, "lineitem", {
            "not_null": K.not_null("l_orderkey", "l_partkey", "l_shipdate"),
            "check_range_quantity": F.col("l_quantity") > 0,
            "check_range_discount": F.col("l_discount").between(0, 0.10),
            "check_in_set_returnflag": K.in_set("l_returnflag", ["A", "N", "R"])}),
        K.foreign_key(li, "l_partkey", part, "p_partkey", "lineitem"),
        K.foreign_key(li, "l_orderkey", orders, "o_orderkey", "lineitem"),
        K.violations(cust, "customer", {"check_length_segment": K.max_length("c_mktsegment", 10)}),
        K.duplicate_keys(g, ["DateKey", "CentroCostoID", "CuentaID"], "gastos"),
        K.violations(g, "gastos", {"check_range_opex": (F.col("OPEXReal") >= 0) & (F.col("OPEXPresupuestado") >= 0)}),
        K.grid_complete(g, ["DateKey", "CentroCostoID", "CuentaID"], "gastos"),
        K.series_gaps(v.select(F.trunc("Fecha", "month").alias("m")), "m", "ventas"),
        v.groupBy("MesDateKey").agg(F.sum("IngresosReales").cast("double").alias("y")).agg(
            F.when(F.stddev_samp("y") > 0, 0).otherwise(1).cast("long").alias("violaciones")).select(
            F.lit("ventas").alias("tabla"), F.lit("check_not_flat").alias("regla"), "violaciones"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- primitives ---------------------------------------------------------------

@query("filter_compare", """SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(l_quantity) AS DOUBLE) AS qty
FROM lineitem WHERE l_quantity BETWEEN 10 AND 40 AND l_discount <> 0.05 AND l_returnflag IN ('A', 'R')
  AND l_linestatus NOT IN ('X') AND l_tax >= 0.02 GROUP BY l_returnflag""")
def q_filter_compare(spark, d):
    """Comparison, BETWEEN, IN / NOT IN predicates (pushed to the scan)."""
    li = read(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    f = li.filter(F.col("l_quantity").between(10, 40) & (F.col("l_discount") != 0.05)
                  & F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("X")
                  & (F.col("l_tax") >= 0.02))
    return f.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query("agg_basic", """SELECT o_orderstatus, CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(12,2))), 2) AS DOUBLE) AS suma,
  ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(o_totalprice), 6) AS promedio,
  MIN(o_totalprice) AS minimo, MAX(o_totalprice) AS maximo, COUNT(*) AS n,
  COUNT(DISTINCT o_custkey) AS clientes FROM orders GROUP BY o_orderstatus""")
def q_agg_basic(spark, d):
    """SUM / AVERAGE / MIN / MAX / COUNT / DISTINCTCOUNT per group."""
    o = read(spark, d, "orders", "o_orderstatus", "o_totalprice", "o_custkey")
    m = F.col("o_totalprice").cast("decimal(12,2)")
    return o.groupBy("o_orderstatus").agg(
        F.round(F.sum(m), 2).cast("double").alias("suma"),
        F.round(F.sum(m).cast("double") / F.count("o_totalprice"), 6).alias("promedio"),
        F.min("o_totalprice").alias("minimo"), F.max("o_totalprice").alias("maximo"),
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("clientes"))


@query("agg_conditional", """SELECT c_mktsegment, CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS pendientes,
  CAST(ROUND(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END), 2) AS DOUBLE) AS abiertos,
  ROUND(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 6) AS pct_urgente
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def q_agg_conditional(spark, d):
    """CALCULATE(SUM, cond) / COUNTROWS(FILTER) / share of group."""
    o = read(spark, d, "orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.groupBy("c_mktsegment").agg(
        F.count_if(F.col("o_orderstatus") == "P").alias("pendientes"),
        F.round(F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast("decimal(12,2)"))
                      .otherwise(F.lit(0))), 2).cast("double").alias("abiertos"),
        F.round(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)) * 100.0 / F.count(F.lit(1)), 6)
        .alias("pct_urgente"))


@query("agg_latest_arg_best", """SELECT user_id, (array_agg(event_type ORDER BY ts DESC, event_type DESC))[1] AS ultimo_evento, max(ts) AS ultimo_ts,
  max(value) AS mayor_valor, (array_agg(event_type ORDER BY value, event_type))[1] AS evento_menor_valor,
  CASE WHEN COUNT(DISTINCT event_type) = 1 THEN MIN(event_type) ELSE 'varios' END AS tipo_unico,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tipos
FROM events GROUP BY user_id""")
def q_agg_latest_arg_best(spark, d):
    """Value at the latest date, attribute at the best metric, single value
    (HASONEVALUE) and CONCATENATEX of the distinct members."""
    e = read(spark, d, "events", "user_id", "event_type", "ts", "value")
    return e.groupBy("user_id").agg(
        F.max(F.struct("ts", "event_type"))["event_type"].alias("ultimo_evento"), F.max("ts").alias("ultimo_ts"),
        F.max("value").alias("mayor_valor"), F.min(F.struct("value", "event_type"))["event_type"].alias("evento_menor_valor"),
        F.when(F.countDistinct("event_type") == 1, F.min("event_type")).otherwise("varios").alias("tipo_unico"),
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("tipos"))


@query("agg_stats", """SELECT event_type, round(var_samp(value), 6) AS var_samp, round(stddev_pop(value), 6) AS std_pop,
  round(quantile_cont(value, 0.5), 6) AS mediana, round(quantile_cont(value, 0.95), 6) AS p95,
  round(corr(value, CAST(user_id AS DOUBLE)), 8) AS corr_user, round(regr_slope(value, CAST(user_id AS DOUBLE)), 8) AS pendiente,
  round(regr_intercept(value, CAST(user_id AS DOUBLE)), 6) AS intercepto,
  round(avg(CASE WHEN value <= (SELECT quantile_cont(value, 0.05) FROM events e2 WHERE e2.event_type = e.event_type) THEN value END), 6) AS media_cola
FROM events e GROUP BY event_type""")
def q_agg_stats(spark, d):
    """Moments, exact percentiles (counted per value bucket first, so no task
    holds a group), correlation, OLS by moments, tail mean."""
    e = read(spark, d, "events", "event_type", "value", "user_id")
    q = exact_quantiles(e, ["event_type"], "value", [0.05, 0.5, 0.95])  # one row per event type
    x = F.col("user_id").cast("double")
    s = e.join(F.broadcast(q), "event_type").groupBy("event_type").agg(
        F.round(F.var_samp("value"), 6).alias("var_samp"), F.round(F.stddev_pop("value"), 6).alias("std_pop"),
        F.round(F.first(F.col("q")[0.5]), 6).alias("mediana"), F.round(F.first(F.col("q")[0.95]), 6).alias("p95"),
        F.round(F.corr("value", x), 8).alias("corr_user"), F.round(F.regr_slope("value", x), 8).alias("pendiente"),
        F.round(F.regr_intercept("value", x), 6).alias("intercepto"),
        F.round(F.avg(F.when(F.col("value") <= F.col("q")[0.05], F.col("value"))), 6).alias("media_cola"))
    return s


@query("json_props", """SELECT event_type, CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS suma_k,
  CAST(MAX(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS max_k FROM events GROUP BY event_type""")
def q_json_props(spark, d):
    """Nested JSON text column parsed with from_json (schema given)."""
    e = read(spark, d, "events", "event_type", "props")
    p = e.withColumn("p", F.from_json("props", "k BIGINT"))
    return p.groupBy("event_type").agg(F.sum("p.k").alias("suma_k"), F.max("p.k").alias("max_k"))


@query("joins_semi_anti_outer", """SELECT 'semi' AS tipo, COUNT(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'anti', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'left_nulls', COUNT(*) FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL
UNION ALL SELECT 'full_outer', COUNT(*) FROM (SELECT DISTINCT s_nationkey AS k FROM supplier) a FULL OUTER JOIN (SELECT DISTINCT c_nationkey AS k FROM customer) b ON a.k = b.k""")
def q_joins_semi_anti_outer(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    o = read(spark, d, "orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    s = read(spark, d, "supplier", "s_nationkey")
    pend = o.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    semi = c.join(pend, "c_custkey", "left_semi").agg(F.count(F.lit(1)).alias("n")).select(F.lit("semi").alias("tipo"), "n")
    anti = c.join(pend, "c_custkey", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("anti").alias("tipo"), "n")
    urg = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).select(
        F.col("o_custkey").alias("k")).distinct()
    left = c.join(urg, c.c_custkey == urg.k, "left").filter(F.col("k").isNull()).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("left_nulls").alias("tipo"), "n")
    a = s.select(F.col("s_nationkey").alias("k")).distinct()
    b = c.select(F.col("c_nationkey").alias("k2")).distinct()
    full = a.join(b, a.k == b.k2, "full_outer").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("full_outer").alias("tipo"), "n")
    return semi.unionByName(anti).unionByName(left).unionByName(full)


@query("asof_ffill_bfill", with_ctes(B.MERCADO_SQL, """cal AS (
  SELECT CAST(unnest(generate_series(MIN(Fecha), MAX(Fecha), INTERVAL 1 DAY)) AS DATE) AS Fecha FROM mercado)""") + """SELECT c.Fecha,
  round(COALESCE(
    (SELECT m.TipoCambioSpot FROM mercado m WHERE m.Fecha <= c.Fecha ORDER BY m.Fecha DESC LIMIT 1),
    (SELECT m.TipoCambioSpot FROM mercado m WHERE m.Fecha >= c.Fecha ORDER BY m.Fecha LIMIT 1)), 6) AS spot
FROM cal c""")
def q_asof_ffill_bfill(spark, d):
    """Align the daily rate to a dense calendar: last value at or before the
    day, head back-filled (union + last/first ignorenulls over the order)."""
    m = B.mercado(spark, d).select("Fecha", "TipoCambioSpot")
    rng = m.agg(F.min("Fecha").alias("a"), F.max("Fecha").alias("b"))
    cal = rng.select(F.explode(F.sequence("a", "b")).alias("Fecha"))
    j = cal.join(m, "Fecha", "left").withColumn("serie", F.lit(0))
    f = ffill_bfill(j, ["serie"], "Fecha", "TipoCambioSpot", "spot")
    return f.select("Fecha", F.round("spot", 6).alias("spot"))


@query("yoy_monthly", with_ctes(B.ventas_sql(channel=False, product=False), """m AS (
  SELECT MesDateKey, Anio, Mes, SUM(IngresosReales) AS ing FROM ventas GROUP BY 1, 2, 3)""") + """SELECT a.Anio, a.Mes,
  CAST(a.ing AS DOUBLE) AS ingresos, CAST(b.ing AS DOUBLE) AS ingresos_anio_anterior,
  CASE WHEN b.ing IS NULL OR b.ing = 0 THEN NULL ELSE round((CAST(a.ing AS DOUBLE) - CAST(b.ing AS DOUBLE)) / abs(CAST(b.ing AS DOUBLE)), 8) END AS variacion_yoy
FROM m a LEFT JOIN m b ON b.Anio = a.Anio - 1 AND b.Mes = a.Mes""")
def q_yoy_monthly(spark, d):
    """Same month of the previous year (self join on year - 1), BLANK when
    there is no prior period."""
    v = B.ventas(spark, d, channel=False, product=False)
    m = v.groupBy("MesDateKey", "Anio", "Mes").agg(F.sum("IngresosReales").alias("ing"))
    p = m.select((F.col("Anio") + 1).alias("Anio"), "Mes", F.col("ing").alias("ing_py"))
    j = m.join(p, ["Anio", "Mes"], "left")
    cur, prev = F.col("ing").cast("double"), F.col("ing_py").cast("double")
    return j.select("Anio", "Mes", cur.alias("ingresos"), prev.alias("ingresos_anio_anterior"),
                    F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise(F.round((cur - prev) / F.abs(prev), 8))
                    .alias("variacion_yoy"))


@query("top_n_share", with_ctes(B.ventas_sql(channel=False, product=False), """s AS (
  SELECT ProductoID, SUM(IngresosReales) AS ing FROM ventas GROUP BY ProductoID)""",
    """top AS (SELECT * FROM s WHERE ing >= (SELECT MIN(ing) FROM (SELECT ing FROM s ORDER BY ing DESC LIMIT 2) t))""") + """SELECT
  CAST(COUNT(*) AS BIGINT) AS productos_top, round(CAST(SUM(ing) AS DOUBLE) / (SELECT CAST(SUM(ing) AS DOUBLE) FROM s), 10) AS concentracion_top2
FROM top""")
def q_top_n_share(spark, d):
    """TOPN(2) with ties kept and its share of the total."""
    v = B.ventas(spark, d, channel=False, product=False)
    s = v.groupBy("ProductoID").agg(F.sum("IngresosReales").alias("ing"))
    top = top_n_ties(s, [], "ing", 2)
    total = s.agg(F.sum("ing").cast("double")).scalar()
    return top.agg(F.count(F.lit(1)).alias("productos_top"),
                   F.round(F.sum("ing").cast("double") / total, 10).alias("concentracion_top2"))


@query("rank_top_per_group", with_ctes(B.ventas_sql(channel=False)) + """SELECT Linea, ProductoID, CAST(ing AS DOUBLE) AS ingresos, r AS ranking FROM (
  SELECT Linea, ProductoID, ing, rank() OVER (PARTITION BY Linea ORDER BY ing DESC) AS r
  FROM (SELECT Linea, ProductoID, SUM(IngresosReales) AS ing FROM ventas GROUP BY 1, 2) g) t WHERE r <= 3""")
def q_rank_top_per_group(spark, d):
    """RANKX ... DESC, Skip per line and top 3 with ties (window group
    limit lets Spark cut each partition before the shuffle)."""
    v = B.ventas(spark, d, channel=False)
    g = v.groupBy("Linea", "ProductoID").agg(F.sum("IngresosReales").alias("ing"))
    r = g.withColumn("ranking", F.rank().over(Window.partitionBy("Linea").orderBy(F.col("ing").desc())))
    return r.filter("ranking <= 3").select("Linea", "ProductoID", F.col("ing").cast("double").alias("ingresos"), "ranking")


@query("set_operations", """SELECT 'except' AS op, COUNT(*) AS n FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier) a
UNION ALL SELECT 'intersect', COUNT(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) b
UNION ALL SELECT 'union_all', COUNT(*) FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier) c""")
def q_set_operations(spark, d):
    c = read(spark, d, "customer", "c_nationkey").select(F.col("c_nationkey").alias("k"))
    s = read(spark, d, "supplier", "s_nationkey").select(F.col("s_nationkey").alias("k"))
    cnt = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
    return cnt(c.subtract(s), "except").unionByName(cnt(c.intersect(s), "intersect")).unionByName(
        cnt(c.unionByName(s), "union_all"))


@query("dedupe_first", """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS primera_orden FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) t WHERE rn = 1""")
def q_dedupe_first(spark, d):
    """Keep the first row per key under a total order."""
    o = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    f = E.dedupe_first(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return f.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("primera_orden"))


@query("densify_months", with_ctes(B.ventas_sql(channel=False, product=False), """m AS (
  SELECT ProductoID, CAST(date_trunc('month', Fecha) AS DATE) AS mes, SUM(IngresosReales) AS ing FROM ventas GROUP BY 1, 2)""", """r AS (
  SELECT ProductoID, CAST(unnest(generate_series(MIN(mes), MAX(mes), INTERVAL 1 MONTH)) AS DATE) AS mes FROM m GROUP BY ProductoID)""") + """SELECT
  r.ProductoID, r.mes, CAST(COALESCE(m.ing, 0) AS DOUBLE) AS ingresos FROM r LEFT JOIN m ON r.ProductoID = m.ProductoID AND r.mes = m.mes""")
def q_densify_months(spark, d):
    """asfreq('MS') of the revenue per SKU: every month between a series' first
    and last, zero where no sales (sequence + explode per series, then a left join)."""
    v = B.ventas(spark, d, channel=False, product=False)
    m = v.groupBy("ProductoID", F.trunc("Fecha", "month").alias("mes")).agg(F.sum("IngresosReales").alias("ing"))
    r = m.groupBy("ProductoID").agg(F.sequence(F.min("mes"), F.max("mes"), F.expr("INTERVAL 1 MONTH")).alias("s"))
    r = r.select("ProductoID", F.explode("s").alias("mes"))
    return r.join(m, ["ProductoID", "mes"], "left").select(
        "ProductoID", "mes", F.coalesce(F.col("ing"), F.lit(0)).cast("double").alias("ingresos"))
