"""ETL jobs: dirty sales extract -> curated sales, calendar, OPEX grain,
quality report.

The dirty extract is derived in-query from the test tables with fixed
per-row rules (four date layouts, case/space noise, decimal commas, currency
prefixes, junk numbers, orphan codes), so the truth is known and an oracle
can rebuild it.  Cleaning is pure Column expressions plus joins against the
dimension key sets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import clean as C
from ledgerlake.operators import etl as E
from ledgerlake.plans import budget as BU
from ledgerlake.registry import query, with_ctes
from ledgerlake.sources import bridge as B
from ledgerlake.sources.tables import read, small

DEFAULT_DATE = dt.date(1995, 1, 1)
DEFAULT_PRODUCT = "PRD-0"

# Channel code dictionary of the sales extract.
CHANNEL_MAP = {
    "HORECA": "Canal Horeca",
    "CANAL HORECA": "Canal Horeca",
    "DIST": "Distribuidor Mayorista",
    "DISTRIBUIDOR MAYORISTA": "Distribuidor Mayorista",
    "RETAIL": "Supermercados",
    "SUPERMERCADOS": "Supermercados",
    "FOB": "Exportacion Directa",
    "CIF": "Exportacion Directa",
    "EXW": "Exportacion Directa",
    "EXPORTACION DIRECTA": "Exportacion Directa",
}
CHANNEL_DEFAULT = "Canal Horeca"
EXPORT_CHANNEL = "Exportacion Directa"

# Dirty-extract rules, shared SQL text (row index i = l_orderkey * 8 + l_linenumber).
_I = "(l_orderkey * 8 + l_linenumber)"
_MATNR = (f"CASE WHEN {_I} % 101 = 0 THEN concat('PRD-X', CAST(l_partkey AS STRING)) "
          f"WHEN {_I} % 11 = 0 THEN concat(' ', lower(concat('PRD-', CAST(l_partkey AS STRING))), ' ') "
          f"WHEN {_I} % 7 = 0 THEN lower(concat('PRD-', CAST(l_partkey AS STRING))) "
          f"WHEN {_I} % 13 = 0 THEN concat('PRD-', CAST(l_partkey AS STRING), ' ') "
          f"ELSE concat('PRD-', CAST(l_partkey AS STRING)) END")
_VKBUR = (f"CASE WHEN {_I} % 89 = 0 THEN 'CC-999' "
          f"WHEN {_I} % 9 = 0 THEN lower({B.SALES_CC}) ELSE {B.SALES_CC} END")
_QTY = f"CAST(CAST(l_quantity AS {B.MONEY}) AS STRING)"
_FKIMG = f"CASE WHEN {_I} % 5 = 0 THEN replace({_QTY}, '.', ',') ELSE {_QTY} END"
_REV = f"CAST(CAST(ROUND({B.REVENUE}, 2) AS DECIMAL(14,2)) AS STRING)"
_NETWR = (f"CASE WHEN {_I} % 53 = 0 THEN 'n/a' WHEN {_I} % 3 = 0 THEN concat('$', {_REV}) "
          f"WHEN {_I} % 3 = 1 THEN concat('ARS ', replace({_REV}, '.', ',')) ELSE {_REV} END")
_CODE = ("CASE c_mktsegment WHEN 'MACHINERY' THEN 'FOB' WHEN 'BUILDING' THEN 'RETAIL' "
         "WHEN 'FURNITURE' THEN 'DIST' WHEN 'HOUSEHOLD' THEN 'HORECA' ELSE 'Canal Horeca' END")
_INCO1 = (f"CASE WHEN {_I} % 11 = 0 THEN concat(' ', lower({_CODE}), ' ') "
          f"WHEN {_I} % 7 = 0 THEN lower({_CODE}) ELSE {_CODE} END")
_VBELN = f"CASE WHEN {_I} % 17 = 0 THEN concat(' ', CAST(l_orderkey AS STRING), ' ') ELSE CAST(l_orderkey AS STRING) END"


def _fkdat(fmt_fn) -> str:
    d = "CAST(l_shipdate AS DATE)"
    return (f"CASE WHEN {_I} % 97 = 0 THEN 'sin fecha' "
            f"WHEN {_I} % 4 = 0 THEN {fmt_fn(d, 'ymd-')} WHEN {_I} % 4 = 1 THEN {fmt_fn(d, 'dmy/')} "
            f"WHEN {_I} % 4 = 2 THEN {fmt_fn(d, 'ymd/')} ELSE {fmt_fn(d, 'dmy-')} END")


def _spark_fmt(d, k):
    return {"ymd-": f"date_format({d}, 'yyyy-MM-dd')", "dmy/": f"date_format({d}, 'dd/MM/yyyy')",
            "ymd/": f"date_format({d}, 'yyyy/MM/dd')", "dmy-": f"date_format({d}, 'dd-MM-yyyy')"}[k]


def _duck_fmt(d, k):
    return {"ymd-": f"strftime({d}, '%Y-%m-%d')", "dmy/": f"strftime({d}, '%d/%m/%Y')",
            "ymd/": f"strftime({d}, '%Y/%m/%d')", "dmy-": f"strftime({d}, '%d-%m-%Y')"}[k]


def raw_sales_extract(spark, d: str) -> DataFrame:
    """Dirty text extract (all strings), one row per line item."""
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_shipdate")
    o = read(spark, d, "orders", "o_orderkey", "o_custkey")
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    oc = o.join(small(c, d, "customer", 32), o.o_custkey == c.c_custkey).select("o_orderkey", "c_mktsegment")
    j = li.join(small(oc, d, "orders", 32), li.l_orderkey == oc.o_orderkey)
    return j.select(F.expr(_VBELN).alias("VBELN"), F.expr(_fkdat(_spark_fmt)).alias("FKDAT"),
                    F.expr(_MATNR).alias("MATNR"), F.expr(_FKIMG).alias("FKIMG"),
                    F.expr(_NETWR).alias("NETWR"), F.expr(_VKBUR).alias("VKBUR"),
                    F.expr(_INCO1).alias("INCO1"))


RAW_SQL = f"""raw AS (
  SELECT {_VBELN} AS VBELN, {_fkdat(_duck_fmt)} AS FKDAT, {_MATNR} AS MATNR, {_FKIMG} AS FKIMG,
         {_NETWR} AS NETWR, {_VKBUR} AS VKBUR, {_INCO1} AS INCO1
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def sales_cost_centres(spark) -> DataFrame:
    """The two sales cost centres (a fixed dimension of the model)."""
    return spark.createDataFrame([(B.CC_DOMESTIC,), (B.CC_EXPORT,)], "CentroCostoID string")


def product_codes(spark, d: str) -> DataFrame:
    codes = read(spark, d, "part", "p_partkey").select(
        F.concat(F.lit("PRD-"), F.col("p_partkey").cast("string")).alias("ProductoID"))
    return small(codes, d, "part", 32)


def clean_sales(raw: DataFrame, products: DataFrame, centres: DataFrame) -> DataFrame:
    """Clean, conform and orphan-resolve the sales extract (keeps flags)."""
    parsed = C.parse_date(F.col("FKDAT"))
    x = raw.select(
        "VBELN", "FKDAT", "MATNR", "FKIMG", "NETWR", "VKBUR", "INCO1",
        F.concat(F.lit("TRX-"), C.clean_string("VBELN")).alias("TransaccionID"),
        parsed.isNull().alias("_bad_date"),
        E.default_date(parsed, DEFAULT_DATE).alias("Fecha"),
        C.clean_string("MATNR", "upper").alias("ProductoID"),
        C.clean_string("VKBUR", "upper").alias("CentroCostoID"),
        F.round(C.clean_number("FKIMG"), 2).alias("VolumenReal"),
        F.round(C.clean_number("NETWR"), 2).alias("IngresosReales"),
        C.map_values(C.clean_string("INCO1", "upper"), CHANNEL_MAP, CHANNEL_DEFAULT).alias("CanalVenta"))
    x = E.resolve_orphans(x, products, "ProductoID", DEFAULT_PRODUCT, flag="_orphan_prod")
    cc_rule = F.when(F.col("CanalVenta") == EXPORT_CHANNEL, B.CC_EXPORT).otherwise(B.CC_DOMESTIC)
    x = E.resolve_orphans(x, centres, "CentroCostoID", cc_rule, flag="_orphan_cc", small_dim=True)
    return x.withColumn("DateKey", F.year("Fecha") * 10000 + F.month("Fecha") * 100 + F.dayofmonth("Fecha"))


SALES_COLS = ["TransaccionID", "DateKey", "ProductoID", "CentroCostoID", "VolumenReal",
              "IngresosReales", "CanalVenta"]

CLEAN_SQL_CTE = f"""clean0 AS (
  SELECT *, 'TRX-' || {C.clean_string_sql('VBELN')} AS TransaccionID,
         {C.parse_date_sql('FKDAT')} AS _parsed,
         {C.clean_string_sql('MATNR', 'upper')} AS _prod,
         {C.clean_string_sql('VKBUR', 'upper')} AS _cc,
         round({C.clean_number_sql('FKIMG')}, 2) AS VolumenReal,
         round({C.clean_number_sql('NETWR')}, 2) AS IngresosReales,
         {C.map_values_sql(C.clean_string_sql('INCO1', 'upper'), CHANNEL_MAP, CHANNEL_DEFAULT)} AS CanalVenta
  FROM raw),
clean AS (
  SELECT *, COALESCE(_parsed, DATE '{DEFAULT_DATE.isoformat()}') AS Fecha,
         _parsed IS NULL AS _bad_date,
         _prod NOT IN (SELECT 'PRD-' || CAST(p_partkey AS VARCHAR) FROM part) AS _orphan_prod,
         _cc NOT IN ('{B.CC_DOMESTIC}', '{B.CC_EXPORT}') AS _orphan_cc,
         CASE WHEN _prod IN (SELECT 'PRD-' || CAST(p_partkey AS VARCHAR) FROM part) THEN _prod
              ELSE '{DEFAULT_PRODUCT}' END AS ProductoID,
         CASE WHEN _cc IN ('{B.CC_DOMESTIC}', '{B.CC_EXPORT}') THEN _cc
              WHEN CanalVenta = '{EXPORT_CHANNEL}' THEN '{B.CC_EXPORT}' ELSE '{B.CC_DOMESTIC}' END AS CentroCostoID
  FROM clean0)"""


@query("etl_sales_clean", with_ctes(RAW_SQL, CLEAN_SQL_CTE) + """SELECT TransaccionID,
  year(Fecha) * 10000 + month(Fecha) * 100 + dayofmonth(Fecha) AS DateKey,
  ProductoID, CentroCostoID, VolumenReal, IngresosReales, CanalVenta FROM clean""")
def q_etl_sales_clean(spark, d):
    return clean_sales(raw_sales_extract(spark, d), product_codes(spark, d),
                       sales_cost_centres(spark)).select(*SALES_COLS)


def sales_quality(cleaned: DataFrame, products: DataFrame, centres: DataFrame) -> DataFrame:
    """Quality metrics of the sales table: one aggregate over the cleaned rows
    (which still carry the raw text).  A key counts as resolved if what it was
    replaced by is in its dimension, found by joining again; curated rows are
    those whose keys and date are all valid."""
    date_fmt_issue = F.col("FKDAT").rlike("/|-") & (F.length("FKDAT") != 10)
    changed = (F.when(date_fmt_issue | F.col("_bad_date"), 1).otherwise(0)
               + C.changed("MATNR", "ProductoID") + C.changed("VKBUR", "CentroCostoID")
               + C.changed("INCO1", "CanalVenta"))
    x = E.flag_orphans(cleaned, products, "ProductoID", flag="_still_prod")
    x = E.flag_orphans(x, centres, "CentroCostoID", flag="_still_cc", small_dim=True)
    found = F.col("_orphan_prod").cast("int") + F.col("_orphan_cc").cast("int") + F.col("_bad_date").cast("int")
    solved = ((F.col("_orphan_prod") & ~F.col("_still_prod")).cast("int") + (F.col("_orphan_cc") & ~F.col("_still_cc")).cast("int")
              + (F.col("_bad_date") & F.col("Fecha").isNotNull()).cast("int"))
    valid = ~F.col("_still_prod") & ~F.col("_still_cc") & F.col("Fecha").isNotNull()
    return x.agg(*E.quality_metrics("Ventas", F.count(F.lit(1)), F.count_if(valid), F.sum(changed), F.sum(found), F.sum(solved)))


def keyed_quality(table: str, lines: DataFrame, missing: list) -> DataFrame:
    """Metrics of a fact whose rows must match their dimensions: ``missing`` are
    flags of keys that no dimension row has; such rows are not curated."""
    bad = F.lit(0)
    none = F.lit(True)
    for m in missing:
        bad, none = bad + m.cast("int"), none & ~m
    return lines.agg(*E.quality_metrics(table, F.count(F.lit(1)), F.count_if(none), F.lit(0), F.sum(bad), F.lit(0)))


@query("quality_report", with_ctes(RAW_SQL, CLEAN_SQL_CTE, B.GASTOS_SQL) + """, q AS (
  SELECT 'Ventas' AS tabla, (SELECT COUNT(*) FROM raw) AS registros_leidos,
         COUNT(*) FILTER (WHERE ProductoID IN (SELECT 'PRD-' || CAST(p_partkey AS VARCHAR) FROM part)) AS registros_curados,
         SUM((CASE WHEN (regexp_matches(FKDAT, '/|-') AND length(FKDAT) <> 10) OR _bad_date THEN 1 ELSE 0 END)
             + (CASE WHEN MATNR IS NOT DISTINCT FROM ProductoID THEN 0 ELSE 1 END)
             + (CASE WHEN VKBUR IS NOT DISTINCT FROM CentroCostoID THEN 0 ELSE 1 END)
             + (CASE WHEN INCO1 IS NOT DISTINCT FROM CanalVenta THEN 0 ELSE 1 END)) AS inconsistencias_corregidas,
         COUNT(*) FILTER (WHERE _orphan_prod) + COUNT(*) FILTER (WHERE _orphan_cc) + COUNT(*) FILTER (WHERE _bad_date) AS claves_huerfanas_detectadas,
         COUNT(*) FILTER (WHERE _orphan_prod AND ProductoID IN (SELECT 'PRD-' || CAST(p_partkey AS VARCHAR) FROM part))
           + COUNT(*) FILTER (WHERE _orphan_cc) + COUNT(*) FILTER (WHERE _bad_date) AS claves_huerfanas_resueltas
  FROM clean
  UNION ALL
  SELECT 'GastosOperativos', (SELECT COUNT(*) FROM opex_lines), (SELECT COUNT(*) FROM gastos),
         (SELECT COUNT(*) FROM opex_lines) - (SELECT COUNT(*) FROM gastos), 0, 0
  UNION ALL
  SELECT 'ProduccionPlanta', COUNT(*), COUNT(*) FILTER (WHERE p_partkey IS NOT NULL AND s_suppkey IS NOT NULL), 0,
         COUNT(*) FILTER (WHERE p_partkey IS NULL) + COUNT(*) FILTER (WHERE s_suppkey IS NULL), 0
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
  UNION ALL
  SELECT 'CapitalTrabajo', COUNT(*), COUNT(*) FILTER (WHERE c_custkey IS NOT NULL), 0, COUNT(*) FILTER (WHERE c_custkey IS NULL), 0
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
t AS (
  SELECT tabla, CAST(registros_leidos AS BIGINT) AS registros_leidos, CAST(registros_curados AS BIGINT) AS registros_curados,
         CAST(inconsistencias_corregidas AS BIGINT) AS inconsistencias_corregidas,
         CAST(claves_huerfanas_detectadas AS BIGINT) AS claves_huerfanas_detectadas,
         CAST(claves_huerfanas_resueltas AS BIGINT) AS claves_huerfanas_resueltas FROM q
  UNION ALL
  SELECT 'TOTAL', SUM(registros_leidos), SUM(registros_curados), SUM(inconsistencias_corregidas),
         SUM(claves_huerfanas_detectadas), SUM(claves_huerfanas_resueltas) FROM q)
SELECT *, CASE WHEN claves_huerfanas_detectadas = claves_huerfanas_resueltas THEN 100.0
  ELSE round(claves_huerfanas_resueltas * 100.0 / greatest(claves_huerfanas_detectadas, 1), 2) END AS tasa_integridad_pct
FROM t""")
def q_quality_report(spark, d):
    products, centres = product_codes(spark, d), sales_cost_centres(spark)
    cleaned = clean_sales(raw_sales_extract(spark, d), products, centres)
    # one pass over the opex lines gives both counts (lines and distinct grains)
    grain = F.struct("DateKey", "CentroCostoID", "CuentaID")
    opex = B.opex_lines(spark, d).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(grain).alias("g")).select(
        *E.quality_metrics("GastosOperativos", F.col("n"), F.col("g"), F.col("n") - F.col("g"), F.lit(0), F.lit(0)))
    li = read(spark, d, "lineitem", "l_partkey", "l_suppkey")
    part = small(read(spark, d, "part", "p_partkey"), d, "part", 16)
    supplier = small(read(spark, d, "supplier", "s_suppkey"), d, "supplier", 16)
    plant = li.join(part, li.l_partkey == part.p_partkey, "left").join(supplier, li.l_suppkey == supplier.s_suppkey, "left")
    orders, customer = read(spark, d, "orders", "o_custkey"), small(read(spark, d, "customer", "c_custkey"), d, "customer", 16)
    capital = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    return E.quality_report([
        sales_quality(cleaned, products, centres), opex,
        keyed_quality("ProduccionPlanta", plant, [F.col("p_partkey").isNull(), F.col("s_suppkey").isNull()]),
        keyed_quality("CapitalTrabajo", capital, [F.col("c_custkey").isNull()])])


@query("build_calendar", with_ctes(RAW_SQL, CLEAN_SQL_CTE, B.PRODUCCION_SQL, B.GASTOS_SQL) + """, rng AS (
  SELECT MIN(dmin) AS dmin, MAX(dmax) AS dmax FROM (
    SELECT MIN(_parsed) AS dmin, MAX(_parsed) AS dmax FROM clean
    UNION ALL SELECT MIN(CAST(l_shipdate AS DATE)), MAX(CAST(l_shipdate AS DATE)) FROM lineitem
    UNION ALL SELECT MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)) FROM orders) u),
days AS (
  SELECT CAST(unnest(generate_series(make_date(year(dmin), 1, 1), dmax + INTERVAL 120 DAY, INTERVAL 1 DAY)) AS DATE) AS Fecha
  FROM rng)
SELECT year(Fecha) * 10000 + month(Fecha) * 100 + dayofmonth(Fecha) AS DateKey, Fecha,
       year(Fecha) AS Anio, month(Fecha) AS MesNumero,
       ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][month(Fecha)] AS MesNombre,
       substr(['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][month(Fecha)], 1, 3) AS MesCorto,
       'T' || CAST(quarter(Fecha) AS VARCHAR) AS Trimestre,
       CASE WHEN month(Fecha) <= 6 THEN 'S1' ELSE 'S2' END AS Semestre,
       CASE WHEN dayofweek(Fecha) IN (0, 6) THEN 1 ELSE 0 END AS EsFinDeSemana
FROM days""")
def q_build_calendar(spark, d):
    # the extract's date text depends on the line alone: no join is needed for it
    text = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate").select(F.expr(_fkdat(_spark_fmt)).alias("FKDAT"))
    parsed = text.select(C.parse_date("FKDAT").alias("f"))
    li = read(spark, d, "lineitem", "l_shipdate").select(F.to_date("l_shipdate").alias("f"))
    o = read(spark, d, "orders", "o_orderdate").select(F.to_date("o_orderdate").alias("f"))
    rng = E.observed_date_range([(parsed, "f"), (li, "f"), (o, "f")])
    return E.build_calendar(rng, 120)


@query("opex_group_to_grain", with_ctes(B.GASTOS_SQL) + """SELECT DateKey, AnioMes, CentroCostoID, CuentaID,
  CAST(OPEXPresupuestado AS DOUBLE) AS OPEXPresupuestado, CAST(OPEXReal AS DOUBLE) AS OPEXReal,
  CAST(DesvioOPEX AS DOUBLE) AS DesvioOPEX,
  CASE WHEN OPEXPresupuestado > 0 THEN round(CAST(DesvioOPEX AS DOUBLE) / CAST(OPEXPresupuestado AS DOUBLE), 4)
       ELSE 0.0 END AS DesvioPorcentual
FROM gastos""")
def q_opex_group_to_grain(spark, d):
    from ledgerlake.functions.scalar import safe_ratio
    g = B.gastos_operativos(spark, d)
    return g.select("DateKey", "AnioMes", "CentroCostoID", "CuentaID",
                    F.col("OPEXPresupuestado").cast("double").alias("OPEXPresupuestado"),
                    F.col("OPEXReal").cast("double").alias("OPEXReal"),
                    F.col("DesvioOPEX").cast("double").alias("DesvioOPEX"),
                    safe_ratio("DesvioOPEX", "OPEXPresupuestado", 4).alias("DesvioPorcentual"))


@query("orphan_detect", with_ctes(RAW_SQL) + """, c AS (
  SELECT upper(regexp_replace(trim(COALESCE(MATNR, '')), '\\s+', ' ', 'g')) AS ProductoID FROM raw)
SELECT ProductoID, CAST(COUNT(*) AS BIGINT) AS n_filas FROM c
WHERE ProductoID NOT IN (SELECT 'PRD-' || CAST(p_partkey AS VARCHAR) FROM part)
GROUP BY ProductoID""")
def q_orphan_detect(spark, d):
    raw = raw_sales_extract(spark, d).select(C.clean_string("MATNR", "upper").alias("ProductoID"))
    return E.orphans(raw, product_codes(spark, d), "ProductoID").groupBy("ProductoID").agg(
        F.count(F.lit(1)).alias("n_filas"))


@query("gold_roundtrip", with_ctes(RAW_SQL, CLEAN_SQL_CTE) + """SELECT CanalVenta, CAST(COUNT(*) AS BIGINT) AS filas,
  round(SUM(IngresosReales), 2) AS IngresosReales, CAST(COUNT(DISTINCT TransaccionID) AS BIGINT) AS transacciones
FROM clean GROUP BY CanalVenta""")
def q_gold_roundtrip(spark, d):
    """Sinks and sources end to end: the curated sales are written as a
    gold CSV under the shared checkpoint folder, read back as raw text
    (all strings) and re-typed with the number cleaner."""
    from ledgerlake.session import scratch_path
    from ledgerlake.sources import io as IO
    cleaned = clean_sales(raw_sales_extract(spark, d), product_codes(spark, d), sales_cost_centres(spark))
    path = scratch_path(spark, "gold")  # removed by session.release
    IO.write_gold(cleaned.select(*SALES_COLS), path, fmt="csv")
    back = IO.read_raw(spark, path, SALES_COLS)
    return back.groupBy("CanalVenta").agg(
        F.count(F.lit(1)).alias("filas"), F.round(F.sum(C.clean_number("IngresosReales")), 2).alias("IngresosReales"),
        F.countDistinct("TransaccionID").alias("transacciones"))


# --- casts to a schema, with the cells that fail -------------------------------

#: Types of the extract's columns; a date counts in the first layout only.
RAW_TYPES = {"VBELN": "bigint", "FKDAT": ("date", r"\d{4}-\d{2}-\d{2}"), "FKIMG": ("decimal(12,2)", r"\d+(\.\d+)?"), "NETWR": ("decimal(14,2)", r"-?\d+(\.\d+)?")}
_RAW_TEXT = {"VBELN": r"\s*\d+\s*", "FKDAT": RAW_TYPES["FKDAT"][1], "FKIMG": RAW_TYPES["FKIMG"][1], "NETWR": RAW_TYPES["NETWR"][1]}


@query("cast_rejects", with_ctes(RAW_SQL) + "SELECT columna, valor, CAST(count(*) AS BIGINT) AS celdas FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS columna, {c} AS valor FROM raw WHERE NOT regexp_full_match({c}, '{p}')" for c, p in _RAW_TEXT.items()) + ") r GROUP BY ALL")
def q_cast_rejects(spark, d):
    """Cells of the dirty extract that their column's type does not take, with their number."""
    return E.cast_columns(raw_sales_extract(spark, d), RAW_TYPES)[1]


@query("cast_columns", with_ctes(RAW_SQL) + f"""SELECT CAST(count(*) AS BIGINT) AS filas, CAST(count(VBELN) FILTER (regexp_full_match(VBELN, '{_RAW_TEXT["VBELN"]}')) AS BIGINT) AS pedidos,
  min(TRY_CAST(FKDAT AS DATE)) FILTER (regexp_full_match(FKDAT, '{_RAW_TEXT["FKDAT"]}')) AS primera, CAST(sum(TRY_CAST(FKIMG AS DECIMAL(12,2))) FILTER (regexp_full_match(FKIMG, '{_RAW_TEXT["FKIMG"]}')) AS DOUBLE) AS volumen,
  CAST(sum(TRY_CAST(NETWR AS DECIMAL(14,2))) FILTER (regexp_full_match(NETWR, '{_RAW_TEXT["NETWR"]}')) AS DOUBLE) AS ingresos FROM raw""")
def q_cast_columns(spark, d):
    """What the typed rows of the dirty extract add up to."""
    typed, _ = E.cast_columns(raw_sales_extract(spark, d), RAW_TYPES)
    return typed.agg(F.count(F.lit(1)).alias("filas"), F.count("VBELN").alias("pedidos"), F.min("FKDAT").alias("primera"),
                     F.sum("FKIMG").cast("double").alias("volumen"), F.sum("NETWR").cast("double").alias("ingresos"))


# --- quality of the dimensions and the plan -------------------------------------

def dimension_quality(table: str, rows: DataFrame, key: str, texts: list[str], foreign: tuple[str, DataFrame, str] | None = None) -> DataFrame:
    """Metrics of a dimension: rows read, distinct keys kept, text cells that cleaning changes and repeated keys, and keys into another
    dimension that this does not have (column, dimension, its key)."""
    x = rows.select(F.col(key).alias("_key"), *[C.changed(c, C.clean_string(c, "title")).alias(f"_c{k}") for k, c in enumerate(texts)],
                    (F.col(foreign[0]) if foreign else F.lit(None)).alias("_foreign"))
    orphan = F.lit(0)
    if foreign:
        x = x.join(foreign[1].select(F.col(foreign[2]).alias("_known")).distinct(), F.col("_foreign") == F.col("_known"), "left")
        orphan = F.col("_known").isNull().cast("int")
    changed = sum((F.col(f"_c{k}") for k in range(len(texts))), F.lit(0))
    rows_, keys = F.count(F.lit(1)), F.count_distinct("_key")
    return x.agg(*E.quality_metrics(table, rows_, keys, F.coalesce(F.sum(changed), F.lit(0)) + rows_ - keys, F.coalesce(F.sum(orphan), F.lit(0)), F.lit(0)))


def _title_sql(c: str) -> str:
    """Upper after any non-letter, lower elsewhere, of the cleaned text."""
    low = f"lower({C.clean_string_sql(c)})"
    return (f"list_aggregate(list_transform(range(1, length({low}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(substr({low}, i - 1, 1), '[\\p{{L}}]') "
            f"THEN upper(substr({low}, i, 1)) ELSE substr({low}, i, 1) END), 'string_agg', '')")


def _dimension_sql(table: str, source: str, key: str, texts: list[str], orphans: str = "0") -> str:
    changed = " + ".join(f"count(*) FILTER (WHERE {c} IS DISTINCT FROM {_title_sql(c)})" for c in texts) or "0"
    return (f"SELECT '{table}' AS tabla, CAST(count(*) AS BIGINT) AS registros_leidos, CAST(count(DISTINCT {key}) AS BIGINT) AS registros_curados, "
            f"CAST({changed} + count(*) - count(DISTINCT {key}) AS BIGINT) AS inconsistencias_corregidas, CAST({orphans} AS BIGINT) AS claves_huerfanas_detectadas, "
            f"CAST(0 AS BIGINT) AS claves_huerfanas_resueltas FROM {source}")


@query("quality_dimensions", with_ctes(B.ventas_sql(), BU.budget_sql(), "calendar AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS f FROM lineitem)", "q AS (" + " UNION ALL ".join([
    _dimension_sql("Productos", "part", "p_partkey", ["p_name"]),
    _dimension_sql("CentrosCosto", "nation", "n_nationkey", ["n_name"], "count(*) FILTER (WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region))"),
    _dimension_sql("PlanCuentas", "(SELECT DISTINCT l_returnflag FROM lineitem) a", "l_returnflag", []),
    _dimension_sql("Calendario", "calendar", "f", []),
    _dimension_sql("Presupuesto", "presupuesto", "(DateKey, ProductoID, CentroCostoID)", [], "count(*) FILTER (WHERE ProductoID NOT IN (SELECT p_brand FROM part))")]) + ")")
       + """SELECT *, CASE WHEN claves_huerfanas_detectadas = claves_huerfanas_resueltas THEN 100.0
  ELSE round(claves_huerfanas_resueltas * 100.0 / greatest(claves_huerfanas_detectadas, 1), 2) END AS tasa_integridad_pct
FROM (SELECT * FROM q UNION ALL SELECT 'TOTAL', CAST(sum(registros_leidos) AS BIGINT), CAST(sum(registros_curados) AS BIGINT), CAST(sum(inconsistencias_corregidas) AS BIGINT),
  CAST(sum(claves_huerfanas_detectadas) AS BIGINT), CAST(sum(claves_huerfanas_resueltas) AS BIGINT) FROM q) t""")
def q_quality_dimensions(spark, d):
    """The quality report of the other tables: products, cost centres, accounts, calendar and plan."""
    part, nation = read(spark, d, "part", "p_partkey", "p_name", "p_brand"), read(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    li = read(spark, d, "lineitem", "l_returnflag", "l_shipdate")
    plan = BU.presupuesto(spark, d).withColumn("_celda", F.struct("DateKey", "ProductoID", "CentroCostoID"))
    return E.quality_report([
        dimension_quality("Productos", part, "p_partkey", ["p_name"]),
        dimension_quality("CentrosCosto", nation, "n_nationkey", ["n_name"], ("n_regionkey", read(spark, d, "region", "r_regionkey"), "r_regionkey")),
        dimension_quality("PlanCuentas", li.select("l_returnflag").distinct(), "l_returnflag", []),
        dimension_quality("Calendario", li.select(F.to_date("l_shipdate").alias("f")).distinct(), "f", []),
        dimension_quality("Presupuesto", plan, "_celda", [], ("ProductoID", part, "p_brand"))])
