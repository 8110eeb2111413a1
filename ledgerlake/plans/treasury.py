"""Treasury and market-risk jobs: Miller-Orr cash bands and daily path,
cash-flow-at-risk from the observed h-day sums of each account, covered-parity
forwards, export receivables and the latest-date FX measures.

Cash flows come from ``events`` (purchase = +4 x value, other = -value) per
day, either as one series or one per user (many independent accounts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.registry import query, with_ctes
from ledgerlake.sources import bridge as B

# Parameters (scaled to the test flows): fixed cost per transfer, lower band,
# foreign annual rate.  The domestic rate is the mean of the market series.
COST_PER_OP = 45.0
LOWER_BAND = 1000.0
FOREIGN_RATE = 0.045

# Actions and labels of the cash path and position bands.
ACT_INVEST = "INVERTIR EN LECAP / MM"
ACT_REDEEM = "RESCATAR FONDOS"
ACT_HOLD = "ZONA DE EQUILIBRIO"


def market_rate(mercado: DataFrame):
    """Mean domestic annual rate of the market series, as a scalar column."""
    return mercado.agg(F.round(F.avg("TasaDomesticaTNA"), 10)).scalar()


def miller_orr_params(flows: DataFrame, tna, c: float = COST_PER_OP, lower: float = LOWER_BAND) -> DataFrame:
    """Per account: variance of daily flows (ddof=1), daily rate
    (1+TNA)^(1/365)-1, return point z = L + cbrt(3 c s2 / (4 r)),
    upper band h = 3z - 2L, expected mean balance (4z - L)/3."""
    g = flows.groupBy("CuentaID").agg(F.var_samp("FlujoNetoDiario").alias("sigma2"), F.stddev_samp("FlujoNetoDiario").alias("sigma"))
    g = g.withColumn("tna", tna).withColumn("r_diaria", F.pow(1.0 + F.col("tna"), F.lit(1.0 / 365.0)) - 1.0)
    zc = F.lit(lower) + F.cbrt(3.0 * c * F.col("sigma2") / (4.0 * F.col("r_diaria")))
    return g.select("CuentaID", "sigma2", "sigma", F.lit(lower).alias("L"), zc.alias("z"), (3.0 * zc - 2.0 * lower).alias("h"),
                    ((4.0 * zc - lower) / 3.0).alias("saldo_medio"), "tna", F.lit(c).alias("c"), "r_diaria")


# Parameter names, the column each shows, digits, unit and description.
PARAMETERS = [
    ("Saldo_Minimo_L", "L", 2, "moneda", "Piso de seguridad de caja"),
    ("Punto_Retorno_Z", "z", 2, "moneda", "Saldo al que vuelve la caja tras intervenir"),
    ("Banda_Superior_H", "h", 2, "moneda", "Saldo desde el que se invierte el exceso"),
    ("Saldo_Promedio_Esperado", "saldo_medio", 2, "moneda", "Saldo medio de largo plazo"),
    ("Varianza_Diaria_Flujos", "sigma2", 2, "moneda^2", "Varianza de los flujos diarios"),
    ("Desvio_Estandar_Diario", "sigma", 2, "moneda", "Desvio de los flujos diarios"),
    ("Tasa_Costo_Oportunidad_Anual", "tna", 4, "tasa anual", "Media de la tasa de mercado"),
    ("Costo_Transaccion_Fijo", "c", 2, "moneda", "Costo fijo de cada operacion"),
]


def params_sql(c=COST_PER_OP, lower=LOWER_BAND) -> str:
    return B.MERCADO_SQL + f""",
params AS (
  SELECT CuentaID, sigma2, sigma, {lower} AS L, z, 3.0 * z - 2.0 * {lower} AS h, (4.0 * z - {lower}) / 3.0 AS saldo_medio, tna, {c} AS c, r_diaria
  FROM (SELECT *, {lower} + cbrt(0.75 * {c} * sigma2 / r_diaria) AS z
        FROM (SELECT CuentaID, var_samp(FlujoNetoDiario) AS sigma2, stddev_samp(FlujoNetoDiario) AS sigma,
                     (SELECT round(avg(TasaDomesticaTNA), 10) FROM mercado) AS tna,
                     (1.0 + (SELECT round(avg(TasaDomesticaTNA), 10) FROM mercado)) ** (1.0 / 365.0) - 1.0 AS r_diaria
              FROM flujos GROUP BY CuentaID) v) t)"""


@query("miller_orr_params", with_ctes(B.flujos_sql(True), params_sql()) + "SELECT CuentaID, Parametro, Valor, Unidad, Descripcion FROM (" + " UNION ALL ".join(
    f"SELECT CuentaID, '{n}' AS Parametro, round(CAST({c} AS DOUBLE), {k}) AS Valor, '{u}' AS Unidad, '{t}' AS Descripcion FROM params" for n, c, k, u, t in PARAMETERS) + ") u")
def q_miller_orr_params(spark, d):
    """Long parameter table (one row per account and parameter)."""
    p = miller_orr_params(B.flujos(spark, d, per_user=True), market_rate(B.mercado(spark, d)))
    rows = F.array(*[F.struct(F.lit(n).alias("Parametro"), F.round(F.col(c).cast("double"), k).alias("Valor"), F.lit(u).alias("Unidad"),
                              F.lit(t).alias("Descripcion")) for n, c, k, u, t in PARAMETERS])
    return p.select("CuentaID", F.inline(rows))


def miller_orr_path(flows: DataFrame, params: DataFrame) -> DataFrame:
    """Daily balance with the band rule: start at z, add each day's flow; at
    or above h invest the excess back to z, at or below L redeem up to z.

    The reset makes this a true recurrence, so each account's days are folded in
    order.  An account's days are one array (bounded by the calendar, not by the
    data volume); accounts are spread over the cluster."""
    days = flows.groupBy("CuentaID").agg(F.sort_array(F.collect_list(F.struct("Fecha", F.col("FlujoNetoDiario").cast("double").alias("f")))).alias("days"))
    j = days.join(params.select("CuentaID", "L", "z", "h", "r_diaria"), "CuentaID")
    low, z, h = F.col("L"), F.col("z"), F.col("h")

    def step(state, day):
        b = state["b"] + day["f"]
        over, under = b >= h, b <= low
        balance = F.when(over | under, z).otherwise(b)
        row = F.struct(day["Fecha"].alias("Fecha"), day["f"].alias("FlujoNetoDiario"), balance.alias("saldo"),
                       F.when(over, ACT_INVEST).when(under, ACT_REDEEM).otherwise(ACT_HOLD).alias("accion"),
                       F.when(over, b - z).when(under, z - b).otherwise(0.0).alias("monto"))
        return F.struct(balance.alias("b"), F.array_append(state["rows"], row).alias("rows"))

    kind = f"array<struct<Fecha:{flows.schema['Fecha'].dataType.simpleString()},FlujoNetoDiario:double,saldo:double,accion:string,monto:double>>"
    folded = F.aggregate("days", F.struct(z.cast("double").alias("b"), F.array().cast(kind).alias("rows")), step)["rows"]
    p = j.select("CuentaID", "L", "z", "h", "r_diaria", F.inline(folded))
    idle = F.greatest(F.lit(0.0), F.col("saldo") - F.col("z"))
    return p.select(
        "CuentaID", "Fecha", F.round("FlujoNetoDiario", 2).alias("FlujoNetoDiario"), F.round("saldo", 2).alias("SaldoEfectivoReal"),
        F.round("L", 2).alias("BandaInferior_L"), F.round("z", 2).alias("PuntoRetorno_Z"), F.round("h", 2).alias("BandaSuperior_H"),
        F.round(idle, 2).alias("SaldoOcioso"), F.round(idle * F.col("r_diaria"), 2).alias("CostoOportunidadDiario"),
        F.col("accion").alias("AccionRecomendada"), F.round("monto", 2).alias("MontoOperacion"))


PATH_SQL = with_ctes(B.flujos_sql(True), params_sql(), """f AS (
  SELECT CuentaID, Fecha, FlujoNetoDiario, ROW_NUMBER() OVER (PARTITION BY CuentaID ORDER BY Fecha) AS rn FROM flujos)""",
    f"""RECURSIVE_PLACEHOLDER""")
PATH_SQL = PATH_SQL.replace("WITH ", "WITH RECURSIVE ", 1).replace(",\nRECURSIVE_PLACEHOLDER", f""",
path(CuentaID, rn, saldo, accion, monto) AS (
  SELECT CuentaID, 0, z, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM params
  UNION ALL
  SELECT p.CuentaID, p.rn + 1,
         CASE WHEN p.saldo + f.FlujoNetoDiario >= pa.h OR p.saldo + f.FlujoNetoDiario <= pa.L THEN pa.z
              ELSE p.saldo + f.FlujoNetoDiario END,
         CASE WHEN p.saldo + f.FlujoNetoDiario >= pa.h THEN '{ACT_INVEST}'
              WHEN p.saldo + f.FlujoNetoDiario <= pa.L THEN '{ACT_REDEEM}' ELSE '{ACT_HOLD}' END,
         CASE WHEN p.saldo + f.FlujoNetoDiario >= pa.h THEN p.saldo + f.FlujoNetoDiario - pa.z
              WHEN p.saldo + f.FlujoNetoDiario <= pa.L THEN pa.z - (p.saldo + f.FlujoNetoDiario) ELSE 0.0 END
  FROM path p JOIN f ON f.CuentaID = p.CuentaID AND f.rn = p.rn + 1 JOIN params pa ON pa.CuentaID = p.CuentaID)""")
PATH_SQL += """SELECT f.CuentaID, f.Fecha, round(f.FlujoNetoDiario, 2) AS FlujoNetoDiario,
  round(p.saldo, 2) AS SaldoEfectivoReal, round(pa.L, 2) AS BandaInferior_L, round(pa.z, 2) AS PuntoRetorno_Z,
  round(pa.h, 2) AS BandaSuperior_H, round(greatest(0.0, p.saldo - pa.z), 2) AS SaldoOcioso,
  round(greatest(0.0, p.saldo - pa.z) * pa.r_diaria, 2) AS CostoOportunidadDiario,
  p.accion AS AccionRecomendada, round(p.monto, 2) AS MontoOperacion
FROM path p JOIN f ON f.CuentaID = p.CuentaID AND f.rn = p.rn JOIN params pa ON pa.CuentaID = p.CuentaID"""


@query("miller_orr_path", PATH_SQL)
def q_miller_orr_path(spark, d):
    flows = B.flujos(spark, d, per_user=True)
    return miller_orr_path(flows, miller_orr_params(flows, market_rate(B.mercado(spark, d))))


def position_band(saldo, h, low):
    return (F.when(saldo.isNull(), F.lit(None).cast("string"))
             .when(saldo >= h, "[COMPRA TITULOS]").when(saldo <= low, "[VENTA TITULOS]")
             .otherwise("[EQUILIBRIO]"))


KPIS_SQL = """SELECT CuentaID, avg(SaldoEfectivoReal) AS SaldoEfectivoRealDiario, avg(BandaInferior_L) AS L,
  avg(PuntoRetorno_Z) AS Z, avg(BandaSuperior_H) AS H, sum(SaldoOcioso) AS DesvioFondoOcioso,
  sum(CostoOportunidadDiario) * 365 / count(*) AS CostoOportunidadAnualizado,
  CASE WHEN avg(SaldoEfectivoReal) IS NULL THEN NULL WHEN avg(SaldoEfectivoReal) >= avg(BandaSuperior_H) THEN '[COMPRA TITULOS]'
       WHEN avg(SaldoEfectivoReal) <= avg(BandaInferior_L) THEN '[VENTA TITULOS]' ELSE '[EQUILIBRIO]' END AS SemaforoPosicionCaja,
  CASE WHEN avg(SaldoEfectivoReal) >= avg(BandaSuperior_H) THEN avg(SaldoEfectivoReal) - avg(PuntoRetorno_Z)
       WHEN avg(SaldoEfectivoReal) <= avg(BandaInferior_L) THEN avg(PuntoRetorno_Z) - avg(SaldoEfectivoReal)
       ELSE 0.0 END AS MontoIntervencion
FROM (""" + PATH_SQL + """) x GROUP BY CuentaID"""


@query("miller_orr_kpis", KPIS_SQL)
def q_miller_orr_kpis(spark, d):
    """Per account: mean balance and bands, idle sum, annualised opportunity
    cost (sum x 365 / days) and the position band of the mean balance."""
    flows = B.flujos(spark, d, per_user=True)
    p = miller_orr_path(flows, miller_orr_params(flows, market_rate(B.mercado(spark, d))))
    g = p.groupBy("CuentaID").agg(
        F.avg("SaldoEfectivoReal").alias("SaldoEfectivoRealDiario"), F.avg("BandaInferior_L").alias("L"),
        F.avg("PuntoRetorno_Z").alias("Z"), F.avg("BandaSuperior_H").alias("H"),
        F.sum("SaldoOcioso").alias("DesvioFondoOcioso"),
        (F.sum("CostoOportunidadDiario") * 365 / F.count(F.lit(1))).alias("CostoOportunidadAnualizado"))
    s, h, low, zc = F.col("SaldoEfectivoRealDiario"), F.col("H"), F.col("L"), F.col("Z")
    return g.withColumn("SemaforoPosicionCaja", position_band(s, h, low)).withColumn(
        "MontoIntervencion", F.when(s >= h, s - zc).when(s <= low, zc - s).otherwise(F.lit(0.0)))


# ---------------------------------------------------------------------------
# Cash flow at risk from the observed flows
# ---------------------------------------------------------------------------

# Days of a holding period in the queries; the test flows cover one month.
HORIZONS = (3, 7, 14)
MODERATE_DEFICIT = -15000000


def horizon_sums(flows: DataFrame, horizons=HORIZONS) -> DataFrame:
    """(CuentaID, HorizonteDias, acc): the net flow of every run of that many
    days of an account, days without flow counting as zero."""
    span = flows.groupBy("CuentaID").agg(F.explode(F.sequence(F.min("Fecha"), F.max("Fecha"))).alias("Fecha"))
    days = span.join(flows, ["CuentaID", "Fecha"], "left").select(
        "CuentaID", "Fecha", F.coalesce(F.col("FlujoNetoDiario").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("f"))
    w = Window.partitionBy("CuentaID").orderBy("Fecha")
    runs = [F.when(F.row_number().over(w) >= h, F.sum("f").over(w.rowsBetween(1 - h, 0))).cast("double") for h in horizons]
    wide = days.select("CuentaID", F.map_from_arrays(F.array(*[F.lit(h) for h in horizons]), F.array(*runs)).alias("m"))
    return wide.select("CuentaID", F.explode("m").alias("HorizonteDias", "acc")).filter("acc is not null")


def cfvar(flows: DataFrame, horizons=HORIZONS, lower: float = LOWER_BAND) -> DataFrame:
    """CF-VaR / CVaR per account and horizon: quantiles of the observed h-day
    sums, tail means below them, required buffer and the risk light.  One group
    has at most as many sums as the calendar has days."""
    acc = horizon_sums(flows, horizons)
    keys = ["CuentaID", "HorizonteDias"]
    q = acc.groupBy(*keys).agg(F.avg("acc").alias("mu"), F.stddev_pop("acc").alias("sd"), F.percentile("acc", [0.05, 0.01]).alias("q"),
                               F.collect_list("acc").alias("all"))
    below = lambda k: F.filter("all", lambda v: v <= F.col("q")[k])
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)
    q = q.select(*keys, "mu", "sd", F.col("q")[0].alias("q95"), F.col("q")[1].alias("q99"), mean(below(0)).alias("cvar95"), mean(below(1)).alias("cvar99"))
    loss = lambda c: F.abs(F.least(F.lit(0.0), F.col(c)))
    return q.select(
        *keys, F.round("mu", 6).alias("FlujoMedioEsperado"), F.round("sd", 6).alias("DesvioEstandar"),
        F.round("q95", 6).alias("FlujoMinimo_Percentil_5"), F.round("q99", 6).alias("FlujoMinimo_Percentil_1"),
        F.round(loss("q95"), 6).alias("CF_VaR_95"), F.round(loss("q99"), 6).alias("CF_VaR_99"),
        F.round(loss("cvar95"), 6).alias("CVaR_95_ExpectedShortfall"), F.round(loss("cvar99"), 6).alias("CVaR_99_ExpectedShortfall"),
        F.round(loss("cvar95") + lower, 6).alias("BufferLiquidezRequerido"),
        F.when(F.col("q95") >= 0, "RIESGO CONTROLADO").when(F.col("q95") >= MODERATE_DEFICIT, "ALERTA DEFICIT MODERADO")
        .otherwise("CRITICO REQUERIMIENTO BUFFER").alias("SemaforoRiesgo"))


def _runs_sql(horizons=HORIZONS, per_user: bool = True) -> str:
    """Oracle: each run of days by a self-join of the flows on dates."""
    return with_ctes(B.flujos_sql(per_user), "span AS (SELECT CuentaID, min(Fecha) AS a, max(Fecha) AS z FROM flujos GROUP BY CuentaID)", f"""runs AS (
  SELECT s.CuentaID, h AS HorizonteDias, e.fin, COALESCE(SUM(CAST(f.FlujoNetoDiario AS DECIMAL(18,2))), 0)::DOUBLE AS acc
  FROM span s, (VALUES {', '.join(f'({h})' for h in horizons)}) hh(h),
       LATERAL (SELECT CAST(unnest(generate_series(s.a + h - 1, s.z, INTERVAL 1 DAY)) AS DATE) AS fin) e
  LEFT JOIN flujos f ON f.CuentaID = s.CuentaID AND f.Fecha <= e.fin AND f.Fecha > e.fin - h
  GROUP BY ALL)""")


_CFVAR_SQL = _runs_sql() + f""", st AS (
  SELECT CuentaID, HorizonteDias, avg(acc) AS mu, stddev_pop(acc) AS sd, quantile_cont(acc, 0.05) AS q95, quantile_cont(acc, 0.01) AS q99
  FROM runs GROUP BY 1, 2),
tl AS (
  SELECT CuentaID, HorizonteDias, avg(acc) FILTER (WHERE acc <= q95) AS c95, avg(acc) FILTER (WHERE acc <= q99) AS c99
  FROM runs JOIN st USING (CuentaID, HorizonteDias) GROUP BY 1, 2)
SELECT CuentaID, HorizonteDias, round(mu, 6) AS FlujoMedioEsperado, round(sd, 6) AS DesvioEstandar, round(q95, 6) AS FlujoMinimo_Percentil_5,
  round(q99, 6) AS FlujoMinimo_Percentil_1, round(greatest(0.0, -q95), 6) AS CF_VaR_95, round(greatest(0.0, -q99), 6) AS CF_VaR_99,
  round(greatest(0.0, -c95), 6) AS CVaR_95_ExpectedShortfall, round(greatest(0.0, -c99), 6) AS CVaR_99_ExpectedShortfall,
  round(greatest(0.0, -c95) + {LOWER_BAND}, 6) AS BufferLiquidezRequerido,
  CASE WHEN q95 >= 0 THEN 'RIESGO CONTROLADO' WHEN q95 >= {MODERATE_DEFICIT} THEN 'ALERTA DEFICIT MODERADO' ELSE 'CRITICO REQUERIMIENTO BUFFER' END AS SemaforoRiesgo
FROM st JOIN tl USING (CuentaID, HorizonteDias)"""


@query("cfvar", _CFVAR_SQL)
def q_cfvar(spark, d):
    return cfvar(B.flujos(spark, d, per_user=True))


# Tail zones of the quantile curve.
ZONES = [(1.0, "Cola Critica 1%"), (5.0, "Cola Alerta 5%"), (95.0, "Rango Mediano")]
ZONE_ABOVE = "Cola Superavitaria"
_POINTS = [0.5 + k for k in range(100)]


def _zone_sql(p: str) -> str:
    return "CASE " + " ".join(f"WHEN {p} <= {limit} THEN '{name}'" for limit, name in ZONES) + f" ELSE '{ZONE_ABOVE}' END"


@query("risk_quantile_curve", _runs_sql((7,)) + f""", q AS (
  SELECT CuentaID, quantile_cont(acc, {[p / 100 for p in _POINTS]}) AS qs FROM runs GROUP BY CuentaID)
SELECT CuentaID, 0.5 + i AS Percentil, round(qs[i + 1], 6) AS FlujoAcumulado, {_zone_sql('0.5 + i')} AS ZonaRiesgo FROM q, range(0, 100) r(i)""")
def q_risk_quantile_curve(spark, d):
    """100 percentiles (0.5 ... 99.5) of each account's observed 7-day flow, with
    the tail zone of each point."""
    q = horizon_sums(B.flujos(spark, d, per_user=True), (7,)).groupBy("CuentaID").agg(F.percentile("acc", [p / 100 for p in _POINTS]).alias("q"))
    p = F.lit(0.5) + F.col("i")
    zone = F.when(p <= ZONES[0][0], ZONES[0][1])
    for limit, name in ZONES[1:]:
        zone = zone.when(p <= limit, name)
    return q.select("CuentaID", F.posexplode("q").alias("i", "v")).select(
        "CuentaID", p.alias("Percentil"), F.round("v", 6).alias("FlujoAcumulado"), zone.otherwise(ZONE_ABOVE).alias("ZonaRiesgo"))


# ---------------------------------------------------------------------------
# FX: covered-parity forwards and latest-date measures
# ---------------------------------------------------------------------------

def cip_forward(mercado: DataFrame, foreign_rate: float = FOREIGN_RATE, days=(30, 90)) -> DataFrame:
    """F = S (1 + i_d d/365) / (1 + i_e d/365) for each horizon, and the
    implied annual rate (F - S) / S x 365 / d."""
    out = mercado
    for dd in days:
        f = F.col("TipoCambioSpot") * (1 + F.col("TasaDomesticaTNA") * dd / 365.0) / (1 + foreign_rate * dd / 365.0)
        out = out.withColumn(f"Forward{dd}d", f).withColumn(
            f"TNAImplicita{dd}d", (F.col(f"Forward{dd}d") - F.col("TipoCambioSpot")) / F.col("TipoCambioSpot") * 365.0 / dd)
    return out


def _cip_sql(days=(30, 90), foreign_rate=FOREIGN_RATE):
    cols = []
    for dd in days:
        fw = f"TipoCambioSpot * (1 + TasaDomesticaTNA * {dd} / 365.0) / (1 + {foreign_rate} * {dd} / 365.0)"
        cols += [f"{fw} AS Forward{dd}d", f"({fw} - TipoCambioSpot) / TipoCambioSpot * 365.0 / {dd} AS TNAImplicita{dd}d"]
    return "cip AS (SELECT *, " + ", ".join(cols) + " FROM mercado)"


@query("cip_forward", with_ctes(B.MERCADO_SQL, _cip_sql()) + """SELECT DateKey, round(TipoCambioSpot, 6) AS TipoCambioSpot,
  round(Forward30d, 6) AS Forward30d, round(Forward90d, 6) AS Forward90d,
  round(TNAImplicita30d, 8) AS TNAImplicita30d, round(TNAImplicita90d, 8) AS TNAImplicita90d FROM cip""")
def q_cip_forward(spark, d):
    c = cip_forward(B.mercado(spark, d))
    return c.select("DateKey", *[F.round(x, 6).alias(x) for x in ("TipoCambioSpot", "Forward30d", "Forward90d")],
                    *[F.round(x, 8).alias(x) for x in ("TNAImplicita30d", "TNAImplicita90d")])


@query("fx_treasury", with_ctes(B.MERCADO_SQL, _cip_sql()) + """, last AS (SELECT * FROM cip WHERE DateKey = (SELECT MAX(DateKey) FROM cip))
SELECT round(TipoCambioSpot, 6) AS SpotActual, round(TNAImplicita90d, 8) AS TNAImplicita3M,
  round(TasaDomesticaTNA, 8) AS TNABenchmark,
  round((TNAImplicita90d - TasaDomesticaTNA) * 10000, 4) AS SpreadArbitrajeBps,
  CASE WHEN (TNAImplicita90d - TasaDomesticaTNA) * 10000 > 150 THEN 'Vender Futuro Rofex (tasa implicita cara)'
       WHEN (TNAImplicita90d - TasaDomesticaTNA) * 10000 < -150 THEN 'Financiar en Pesos (cobertura cara)'
       ELSE 'Calce / Indiferencia' END AS RecomendacionCobertura
FROM last""")
def q_fx_treasury(spark, d):
    """Latest-date spot, implied 3M rate, benchmark, spread and the hedge
    advice (``max_by`` on the date: no sort of the series)."""
    c = cip_forward(B.mercado(spark, d))
    last = c.agg(F.max_by(F.struct("TipoCambioSpot", "TNAImplicita90d", "TasaDomesticaTNA"), "DateKey").alias("x"))
    spread = (F.col("x.TNAImplicita90d") - F.col("x.TasaDomesticaTNA")) * 10000
    return last.select(
        F.round("x.TipoCambioSpot", 6).alias("SpotActual"), F.round("x.TNAImplicita90d", 8).alias("TNAImplicita3M"),
        F.round("x.TasaDomesticaTNA", 8).alias("TNABenchmark"), F.round(spread, 4).alias("SpreadArbitrajeBps"),
        F.when(spread > 150, "Vender Futuro Rofex (tasa implicita cara)")
        .when(spread < -150, "Financiar en Pesos (cobertura cara)").otherwise("Calce / Indiferencia")
        .alias("RecomendacionCobertura"))


# ---------------------------------------------------------------------------
# Reverse stress testing: shock scenarios applied to data-derived bases
# ---------------------------------------------------------------------------

# Levels of the query; callers give their own table of scenarios.
SCENARIOS = [("S0", "Sin shock", 0.0, 0, 0.0, 0), ("S1", "Leve", -0.1, 10, 0.1, 250),
             ("S2", "Medio", -0.2, 30, 0.25, 500), ("S3", "Severo", -0.4, 60, 0.5, 1000)]
SCENARIO_COLUMNS = ("EscenarioID string, NombreEscenario string, ShockVentasPct double, ShockMoraDias int, "
                    "ShockDevaluacionInsumosPct double, ShockTasaInteresBps int")
SOLVENCY_RULES = [("<=", 0, "INSOLVENCIA"), ("<", 15000000, "BUFFER ALERTA")]
SOLVENCY_DEFAULT = "RESILIENTE"
BASE_BUFFER_MONTHS = 1.0   # base solvency buffer = this many months of cost


def stress_scenarios(scenarios: DataFrame, ventas: DataFrame, capital: DataFrame,
                     buffer_months: float = BASE_BUFFER_MONTHS) -> DataFrame:
    """Monthly cash impact of each scenario on the average month:
    sales shock x revenue - extra collection days x daily revenue - input
    devaluation x cost - rate shock x average receivables; remaining buffer
    from a base of ``buffer_months`` of cost; days of cost it covers.  The
    bases are one-row aggregates used as scalars (no join of the data)."""
    m = ventas.groupBy("Anio", "Mes").agg(F.sum("IngresosReales").cast("double").alias("ing"),
                                          F.sum("CostoReal").cast("double").alias("cost"))
    ing = m.agg(F.avg("ing")).scalar()
    cost = m.agg(F.avg("cost")).scalar()
    cxc = capital.agg(F.avg(F.col("CuentasPorCobrar").cast("double"))).scalar()
    impact = (F.col("ShockVentasPct") * ing - F.col("ShockMoraDias") * ing / 30.0
              - F.col("ShockDevaluacionInsumosPct") * cost - F.col("ShockTasaInteresBps") / 10000.0 * cxc)
    buf = cost * buffer_months + impact
    return scenarios.select("EscenarioID", "NombreEscenario", "ShockVentasPct", "ShockMoraDias",
                     "ShockDevaluacionInsumosPct", "ShockTasaInteresBps",
                     F.round(impact, 2).alias("ImpactoCajaNeto"), F.round(buf, 2).alias("BufferSolvenciaRestante"),
                     F.greatest(F.lit(0), F.floor(buf / (cost / 30.0))).cast("int").alias("DiasCoberturaRestante"))


def _scenarios_sql() -> str:
    rows = ", ".join(f"('{a}', '{b}', {c}, {d}, {e}, {f})" for a, b, c, d, e, f in SCENARIOS)
    return (f"sc AS (SELECT * FROM (VALUES {rows}) t(EscenarioID, NombreEscenario, ShockVentasPct, ShockMoraDias, "
            "ShockDevaluacionInsumosPct, ShockTasaInteresBps))")


_STRESS_SQL = with_ctes(B.ventas_sql(), B.CAPITAL_SQL, """m AS (
  SELECT Anio, Mes, CAST(SUM(IngresosReales) AS DOUBLE) AS ing, CAST(SUM(CostoReal) AS DOUBLE) AS cost
  FROM ventas GROUP BY 1, 2)""", """b AS (SELECT (SELECT avg(ing) FROM m) AS ing, (SELECT avg(cost) FROM m) AS cost,
  (SELECT avg(CAST(CuentasPorCobrar AS DOUBLE)) FROM capital) AS cxc)""", _scenarios_sql(), f"""st AS (
  SELECT EscenarioID, NombreEscenario, CAST(ShockVentasPct AS DOUBLE) AS ShockVentasPct, CAST(ShockMoraDias AS INT) AS ShockMoraDias,
         CAST(ShockDevaluacionInsumosPct AS DOUBLE) AS ShockDevaluacionInsumosPct,
         CAST(ShockTasaInteresBps AS INT) AS ShockTasaInteresBps,
         ShockVentasPct * ing - ShockMoraDias * ing / 30.0 - ShockDevaluacionInsumosPct * cost
           - ShockTasaInteresBps / 10000.0 * cxc AS impact, cost
  FROM sc, b)""")


@query("stress_scenarios", _STRESS_SQL + f"""SELECT EscenarioID, NombreEscenario, ShockVentasPct, ShockMoraDias,
  ShockDevaluacionInsumosPct, ShockTasaInteresBps, round(impact, 2) AS ImpactoCajaNeto,
  round(cost * {BASE_BUFFER_MONTHS} + impact, 2) AS BufferSolvenciaRestante,
  CAST(greatest(0, floor((cost * {BASE_BUFFER_MONTHS} + impact) / (cost / 30.0))) AS INT) AS DiasCoberturaRestante
FROM st""")
def q_stress_scenarios(spark, d):
    return stress_scenarios(spark.createDataFrame(SCENARIOS, SCENARIO_COLUMNS), B.ventas(spark, d), B.capital_trabajo(spark, d))


@query("stress_summary", _STRESS_SQL + f""", x AS (SELECT EscenarioID, NombreEscenario,
  round(impact, 2) AS imp, round(cost * {BASE_BUFFER_MONTHS} + impact, 2) AS buf,
  CAST(greatest(0, floor((cost * {BASE_BUFFER_MONTHS} + impact) / (cost / 30.0))) AS INT) AS dias FROM st)
SELECT MIN(buf) AS BufferSolvenciaMinimo, MIN(dias) AS DiasCoberturaMinimo,
  MAX(CASE WHEN EscenarioID = 'S0' THEN buf END) AS BufferSolvenciaBase, MIN(imp) AS ImpactoCajaMaximo,
  (array_agg(NombreEscenario ORDER BY buf, NombreEscenario))[1] AS EscenarioMayorRiesgo,
  CASE WHEN MIN(buf) <= 0 THEN 'INSOLVENCIA' WHEN MIN(buf) < 15000000 THEN 'BUFFER ALERTA' ELSE 'RESILIENTE' END AS SemaforoSolvencia
FROM x""")
def q_stress_summary(spark, d):
    """Minimum buffer and cover, base buffer, largest impact, the worst
    scenario (min_by) and the solvency light."""
    s = stress_scenarios(spark.createDataFrame(SCENARIOS, SCENARIO_COLUMNS), B.ventas(spark, d), B.capital_trabajo(spark, d))
    g = s.agg(F.min("BufferSolvenciaRestante").alias("BufferSolvenciaMinimo"),
              F.min("DiasCoberturaRestante").alias("DiasCoberturaMinimo"),
              F.max(F.when(F.col("EscenarioID") == "S0", F.col("BufferSolvenciaRestante"))).alias("BufferSolvenciaBase"),
              F.min("ImpactoCajaNeto").alias("ImpactoCajaMaximo"),
              F.min(F.struct("BufferSolvenciaRestante", "NombreEscenario"))["NombreEscenario"].alias("EscenarioMayorRiesgo"))
    b = F.col("BufferSolvenciaMinimo")
    return g.withColumn("SemaforoSolvencia", F.when(b <= 0, "INSOLVENCIA").when(b < 15000000, "BUFFER ALERTA")
                        .otherwise("RESILIENTE"))


# ---------------------------------------------------------------------------
# Monthly forward curve and export receivables
# ---------------------------------------------------------------------------

# Labels of the forward/spot check and its limit.
FORWARD_OK, FORWARD_ALERT, FORWARD_CORRELATION = "OK", "ALERTA", 0.95


@query("cip_monthly", with_ctes(B.MERCADO_SQL, _cip_sql()) + f""", c AS (
  SELECT CAST(date_trunc('month', Fecha) AS DATE) AS Mes, TipoCambioSpot AS s, Forward30d AS f FROM cip),
m AS (SELECT Mes, avg(s) AS s, avg(f) AS f FROM c GROUP BY Mes)
SELECT Mes, round(s, 6) AS Spot, round(f, 6) AS Forward30d, round((f - s) / s, 8) AS Prima,
  round((SELECT corr(s, f) FROM m), 6) AS Correlacion, CASE WHEN (SELECT corr(s, f) FROM m) > {FORWARD_CORRELATION} THEN '{FORWARD_OK}' ELSE '{FORWARD_ALERT}' END AS Chequeo
FROM m""")
def q_cip_monthly(spark, d):
    """Monthly mean spot and 30-day forward, the premium, and the check that the
    two move together over all months."""
    c = cip_forward(B.mercado(spark, d))
    m = c.groupBy(F.trunc("Fecha", "month").alias("Mes")).agg(F.avg("TipoCambioSpot").alias("s"), F.avg("Forward30d").alias("f"))
    r = m.agg(F.corr("s", "f")).scalar()
    return m.withColumn("r", r).select(
        "Mes", F.round("s", 6).alias("Spot"), F.round("f", 6).alias("Forward30d"), F.round((F.col("f") - F.col("s")) / F.col("s"), 8).alias("Prima"),
        F.round("r", 6).alias("Correlacion"), F.when(F.col("r") > FORWARD_CORRELATION, FORWARD_OK).otherwise(FORWARD_ALERT).alias("Chequeo"))


@query("receivables_fx", with_ctes(B.cobranzas_sql(), B.MERCADO_SQL) + """SELECT Anio, round(avg(PlazoDiasCobro), 4) AS PlazoPromedioCobroDias, CAST(COUNT(*) AS BIGINT) AS Cobranzas,
  (SELECT CAST(SUM(ImporteFOB) AS DOUBLE) FROM cobranzas WHERE EstadoCobranza = 'Pendiente') AS CobranzasPendientes,
  (SELECT CAST(SUM(ImporteFOB) AS DOUBLE) FROM cobranzas WHERE EstadoCobranza = 'Cobrado') AS CobranzasCobradas,
  (SELECT COUNT(*) FROM cobranzas WHERE EstadoCobranza = 'Pendiente') AS CantidadPendientes,
  round((SELECT CAST(SUM(ImporteFOB) AS DOUBLE) FROM cobranzas WHERE EstadoCobranza = 'Pendiente')
        * (SELECT TipoCambioSpot FROM mercado WHERE Fecha = (SELECT max(Fecha) FROM mercado)), 2) AS ExposicionNetaLocal
FROM cobranzas GROUP BY Anio""")
def q_receivables_fx(spark, d):
    """Per year: mean term and count in that year; amounts pending and collected,
    pending count and exposure at the latest spot over all years, as those
    measures drop the calendar filter."""
    c = B.cobranzas(spark, d)
    pending = F.col("EstadoCobranza") == "Pendiente"
    whole = c.agg(F.sum(F.when(pending, F.col("ImporteFOB"))).cast("double").alias("p"), F.sum(F.when(~pending, F.col("ImporteFOB"))).cast("double").alias("c"),
                  F.count_if(pending).alias("n"))
    spot = B.mercado(spark, d).agg(F.max(F.struct("Fecha", "TipoCambioSpot"))["TipoCambioSpot"].alias("s"))
    by_year = c.groupBy("Anio").agg(F.round(F.avg("PlazoDiasCobro"), 4).alias("PlazoPromedioCobroDias"), F.count(F.lit(1)).alias("Cobranzas"))
    # one-row tables on the right
    return by_year.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(spot)).select(
        "Anio", "PlazoPromedioCobroDias", "Cobranzas", F.col("p").alias("CobranzasPendientes"), F.col("c").alias("CobranzasCobradas"),
        F.col("n").alias("CantidadPendientes"), F.round(F.col("p") * F.col("s"), 2).alias("ExposicionNetaLocal"))
