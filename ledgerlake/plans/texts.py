"""Narrative measures of the suites: diagnosis, executive summary, prescriptions.

The texts are templates (:mod:`ledgerlake.functions.templates`) over measures that the
measure layer and the forecasting, cointegration and treasury jobs give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.templates import Text, column, compiled, text
from ledgerlake.plans import econometrics as EC
from ledgerlake.plans import finance as FI
from ledgerlake.plans import model as M
from ledgerlake.plans import plant as PL
from ledgerlake.plans import series as SE
from ledgerlake.plans import treasury as TR
from ledgerlake.registry import query, with_ctes
from ledgerlake.sources import bridge as B

# The texts of the suites' measures.
YOY = text(("VariacionYoY IS NULL", "Sin periodo anterior comparable"), ("VariacionYoY >= 0", "+{VariacionYoY:pct1} vs. año anterior"),
           (None, "{VariacionYoY:pct1} vs. año anterior"))
PERIOD = text(("Anio IS NULL", "Todos (todos los meses)"), (None, "{Anio} (todos los meses)"))
SUMMARY = text(
    ("Estado = 'CUMPLE'", "SITUACION: En objetivo para {Periodo}. El cumplimiento es positivo con {VariacionYoYTexto}. Impulsor principal: {TopCausa}."),
    ("Estado = 'ALERTA'", "ATENCION: Desvio moderado ({DesvioAbs:pct1} bajo plan) en {Periodo}. {VariacionYoYTexto}. Revisar: {TopCausa}."),
    ("Estado = 'CRITICO'", "ACCION URGENTE: Desvio critico ({DesvioAbs:pct1} bajo plan) en {Periodo}. {VariacionYoYTexto}. "
                           "Dimension mas comprometida: {TopCausa}. Se requiere plan de recuperacion."))
COMMERCIAL = text(
    ("Estado = 'CUMPLE'", "Objetivo cumplido ({Cumplimiento:pct1} | {Delta:change} vs plan {Plan:millions}): {TopCausa} lidera colocacion. Accion: Blindar stock."),
    ("Estado = 'ALERTA'", "Desvio moderado ({Cumplimiento:pct1} | {Delta:change} vs plan {Plan:millions}): Brecha en {TopCausa}. Accion: Revisar bonificaciones."),
    ("Estado = 'CRITICO'", "Desvio critico ({Cumplimiento:pct1} | {Delta:change} vs plan {Plan:millions}): Brecha en {TopCausa}. Accion: Suspender bonificaciones."))
PLANT = text(
    ("Estado = 'CUMPLE'", "KPI en objetivo. {TopCausa} es el principal impulsor positivo ({Magnitud:pct1} s/ppto)."),
    ("Estado = 'ALERTA'", "Desvio moderado. {TopCausa} concentra la mayor brecha ({Magnitud:pct1}). Real: {Real:money} | Ppto: {Plan:money}."),
    ("Estado = 'CRITICO'", "ACCION REQUERIDA: {TopCausa} presenta desvio critico ({Magnitud:pct1}). Real: {Real:money} vs Ppto: {Plan:money}."))
COINTEGRATION = text(
    ("p_value IS NULL", "Analisis de cointegracion no disponible"),
    ("p_value < 0.05", "RELACION DE LARGO PLAZO CONFIRMADA (Engle-Granger p={p_value:dec3} < 0.05). Existe equilibrio estacionario entre precio y volumen. "
                       "La demanda absorbe ajustes tarifarios alineados a la inflacion."),
    (None, "AUSENCIA DE COINTEGRACION (Engle-Granger p={p_value:dec3} >= 0.05). Ruptura estructural detectada. Shocks de precio generan efectos permanentes; "
           "prohibido aplicar subas por encima del promedio de la competencia."))
DEMAND = text(
    (f"Ganador <> '{EC.NAIVE}'", "Plan de demanda: {Ganador} lidera precision predictiva (RMSE {RMSE:int}). Adoptar proyeccion para programa maestro de embotellado."),
    (None, "Plan de demanda: {Ganador} lidera precision predictiva (RMSE {RMSE:int}). Mantener modelo para programa maestro de embotellado."))
TREASURY = text(("Saldo IS NULL", "Sin saldo registrado"), ("Saldo >= H", "Invertir excedente en LECAP / FCI Money Market"),
                ("Saldo <= L", "Rescatar FCI o descontar cheques en mercado"), (None, "Mantener posicion en equilibrio"))
PEAK = text((None, "PICO ESTACIONAL PREVISTO: {NombreMes} (Indice={Indice:dec2}). Accion: Anticipar ordenes de compra de botellas y corchos a 60 dias "
                   "para evitar quiebre de stock en planta."))


def with_texts(df: DataFrame, texts: dict[str, Text]) -> DataFrame:
    for name, t in texts.items():
        df = df.withColumn(name, column(t))
    return df


def texts_sql(body: str, texts: dict[str, Text]) -> str:
    for name, t in texts.items():
        body = f"SELECT *, {compiled(t, 'duckdb')} AS {name} FROM ({body}) q_{name}"
    return body


def top_members(detail: DataFrame, by: list[str], member: str, value: str, prefix: str = "") -> DataFrame:
    """Per context the member with the largest ``value`` in size (ties: all, in order; a null counts as 0): ``TopCausa``, ``Magnitud``."""
    x = detail.withColumn("_v", F.round(F.abs(F.coalesce(F.col(value), F.lit(0.0))), 10))
    best = x.groupBy(*by).agg(F.max("_v").alias("Magnitud"))
    return (x.join(best, by).where("_v = Magnitud").groupBy(*by, "Magnitud")
            .agg(F.array_join(F.sort_array(F.collect_set(F.concat(F.lit(prefix), F.col(member).cast("string")))), ", ").alias("TopCausa")))


def top_members_sql(detail: str, by: list[str], member: str, value: str, prefix: str = "") -> str:
    k = ", ".join(by)
    return f"""SELECT {k}, max(v) AS Magnitud, string_agg(DISTINCT '{prefix}' || {member}, ', ' ORDER BY '{prefix}' || {member}) AS TopCausa FROM (
  SELECT *, rank() OVER (PARTITION BY {k} ORDER BY v DESC) AS place FROM (SELECT *, round(abs(coalesce({value}, 0)), 10) AS v FROM ({detail}) d) x) r WHERE place = 1 GROUP BY {k}"""


# --- controller ---------------------------------------------------------------

_STATE = FI._pick("IngresosReales", "IngresosPresupuesto", "DesvioIngresos", "DesvioIngresosPct", "SemaforoKPI", "RealAnioAnterior", "VariacionYoY")
_NAMED = {"Estado": "SemaforoKPI", "DesvioAbs": "abs(DesvioIngresosPct)", "Plan": "IngresosPresupuesto", "Delta": "DesvioIngresos",
          "Cumplimiento": M.div("IngresosReales", "IngresosPresupuesto", "NULL")}
_CTL_TEXTS = {"VariacionYoYTexto": YOY, "Periodo": PERIOD, "ResumenEjecutivo": SUMMARY}
_CTL_COLUMNS = ["Anio", "Estado", "VariacionYoYTexto", "Periodo", "TopCausa", "ResumenEjecutivo"]


def _named(body: str, names: dict[str, str]) -> str:
    return f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in names.items())} FROM ({body}) named"


@query("ctl_texts_by_year", f"""SELECT {', '.join(_CTL_COLUMNS)} FROM (""" + texts_sql(
    f"SELECT w.*, t.TopCausaDesvio AS TopCausa FROM ({_named(M.evaluate_sql(_STATE, ['Anio']), _NAMED)}) w LEFT JOIN ({FI._top_cause_sql(['Anio'], 'Linea')}) t USING (Anio)", _CTL_TEXTS) + ") f")
def q_ctl_texts_by_year(spark, d):
    """Executive summary of the controller per year."""
    cube = M.sales_cube(spark, d)
    cause = FI.top_cause(M.evaluate(spark, d, FI._CAUSE, ["Anio"], cube=cube), M.evaluate(spark, d, FI._CAUSE, ["Anio", "Linea"], cube=cube), ["Anio"], "Linea")
    w = M.evaluate(spark, d, _STATE, ["Anio"], cube=cube).withColumns({n: F.expr(e) for n, e in _NAMED.items()})
    w = w.join(cause.select("Anio", F.col("TopCausaDesvio").alias("TopCausa")), "Anio", "left")
    return with_texts(w, _CTL_TEXTS).select(_CTL_COLUMNS)


# --- commercial: by line, and by channel where one line is selected ------------

_COM_TEXTS = {"VariacionYoYTexto": YOY, "Periodo": PERIOD, "DiagnosticoCausal": COMMERCIAL, "ResumenEjecutivo": SUMMARY}
_DEVIATION = FI._pick("IngresosReales", "IngresosPresupuesto", "DesvioIngresos", "DesvioIngresosPct")


def _commercial(spark, d, by: list[str], member: str, prefix: str, where: dict | None = None) -> DataFrame:
    cube = M.sales_cube(spark, d)
    top = top_members(M.evaluate(spark, d, _DEVIATION, [*by, member], where, cube=cube), by, member, "DesvioIngresosPct", prefix)
    w = M.evaluate(spark, d, _STATE, by, where, cube=cube).withColumns({n: F.expr(e) for n, e in _NAMED.items()}).join(top, by, "left")
    return with_texts(w, _COM_TEXTS).select(*by, "Estado", "TopCausa", F.round("Magnitud", 8).alias("Magnitud"), *_COM_TEXTS)


def _commercial_sql(by: list[str], member: str, prefix: str, where: dict | None = None) -> str:
    k = ", ".join(by)
    return f"SELECT {k}, Estado, TopCausa, round(Magnitud, 8) AS Magnitud, {', '.join(_COM_TEXTS)} FROM (" + texts_sql(
        f"SELECT * FROM ({_named(M.evaluate_sql(_STATE, by, where), _NAMED)}) w LEFT JOIN ({top_members_sql(M.evaluate_sql(_DEVIATION, [*by, member], where), by, member, 'DesvioIngresosPct', prefix)}) t USING ({k})",
        _COM_TEXTS) + ") f"


@query("com_texts_by_year", _commercial_sql(["Anio"], "Linea", "Línea "))
def q_com_texts_by_year(spark, d):
    """Commercial diagnosis per year: the line with the largest deviation from its quota."""
    return _commercial(spark, d, ["Anio"], "Linea", "Línea ")


_ONE_LINE = {"Linea": "Brand#11"}


@query("com_texts_one_line", _commercial_sql(["Anio"], "CentroCostoID", "Canal ", _ONE_LINE))
def q_com_texts_one_line(spark, d):
    """The same with one line selected: the cause is sought among the sales channels (by cost centre, which the budget knows)."""
    return _commercial(spark, d, ["Anio"], "CentroCostoID", "Canal ", _ONE_LINE)


# --- plant --------------------------------------------------------------------

_PLANT = [m for m in PL.OPS if m[0] in ("TotalKilosUva", "CostoTotalFabril", "CostoPresupuestoFabril", "DesvioFabrilTotal", "DesvioFabrilPct", "SemaforoKPIPlanta")]
_PLANT_NAMED = {"Estado": "SemaforoKPIPlanta", "DesvioAbs": "abs(DesvioFabrilPct)", "Real": "CostoTotalFabril", "Plan": "CostoPresupuestoFabril",
                "VariacionYoY": M.div("TotalKilosUva - KilosAnioAnterior", "abs(KilosAnioAnterior)", "NULL")}
_PLANT_TEXTS = {"VariacionYoYTexto": YOY, "Periodo": PERIOD, "DiagnosticoCausal": PLANT, "ResumenEjecutivo": SUMMARY}


@query("ops_texts_by_year", f"SELECT Anio, Estado, TopCausa, round(Magnitud, 8) AS Magnitud, {', '.join(_PLANT_TEXTS)} FROM (" + texts_sql(
    f"WITH y AS ({M.evaluate_sql(_PLANT, ['Anio'])}) SELECT * FROM ({_named('SELECT y.*, p.TotalKilosUva AS KilosAnioAnterior FROM y LEFT JOIN y p ON p.Anio = y.Anio - 1', _PLANT_NAMED)}) w "
    f"LEFT JOIN ({top_members_sql(M.evaluate_sql(_PLANT, ['Anio', 'VariedadUva']), ['Anio'], 'VariedadUva', 'DesvioFabrilPct')}) t USING (Anio)", _PLANT_TEXTS) + ") f")
def q_ops_texts_by_year(spark, d):
    """Plant diagnosis per year.  Costs know no grape variety, so the deviation repeats and all varieties of a year tie."""
    w = M.evaluate(spark, d, _PLANT, ["Anio"])
    prior = w.select((F.col("Anio") + 1).alias("Anio"), F.col("TotalKilosUva").alias("KilosAnioAnterior"))  # one row per year
    top = top_members(M.evaluate(spark, d, _PLANT, ["Anio", "VariedadUva"]), ["Anio"], "VariedadUva", "DesvioFabrilPct")
    w = w.join(prior, "Anio", "left").withColumns({n: F.expr(e) for n, e in _PLANT_NAMED.items()}).join(top, "Anio", "left")
    return with_texts(w, _PLANT_TEXTS).select("Anio", "Estado", "TopCausa", F.round("Magnitud", 8).alias("Magnitud"), *_PLANT_TEXTS)


# --- forecasts, cointegration, treasury, season ---------------------------------

@query("forecast_winner", with_ctes(*EC._CAND_CTES, *EC._HR_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT serie, Ganador, round(RMSE, 2) AS RMSE, round(MAPE, 4) AS MAPE_Pct,
  round(100 - MAPE, 4) AS PrecisionPct, round((base - RMSE) / base * 100, 4) AS Reduccion_RMSE_Pct, round(amplitud, 2) AS AmplitudBanda, {compiled(DEMAND, 'duckdb')} AS Prescripcion
FROM (SELECT serie, arg_min(Modelo, (RMSE, Modelo)) AS Ganador, min(RMSE) AS RMSE, arg_min(MAPE_Pct, (RMSE, Modelo)) AS MAPE, max(RMSE) FILTER (Modelo = '{EC.NAIVE}') AS base FROM met GROUP BY serie) w
LEFT JOIN (SELECT serie, Modelo AS Ganador, avg(2 * {EC.BAND} * error) AS amplitud FROM cand GROUP BY ALL) a USING (serie, Ganador)""")
def q_forecast_winner(spark, d):
    """Winner of the forecast candidates per segment: its errors, the gain against the benchmark, mean width of its band and the
    prescription for the demand plan."""
    c = EC.forecast_candidates(SE.monthly_series(B.ventas(spark, d, channel=False), "Segmento"))
    m = EC.candidate_metrics(c)
    best = m.where("Ranking_Precision = 1").withColumnRenamed("Modelo", "Ganador")
    width = c.groupBy("serie", F.col("Modelo").alias("Ganador")).agg(F.avg(2 * EC.BAND * F.col("error")).alias("AmplitudBanda"))
    out = best.join(width, ["serie", "Ganador"], "left").withColumn("Prescripcion", column(DEMAND))
    return out.select("serie", "Ganador", F.round("RMSE", 2).alias("RMSE"), F.round("MAPE_Pct", 4).alias("MAPE_Pct"), F.round(100 - F.col("MAPE_Pct"), 4).alias("PrecisionPct"),
                      F.round("Reduccion_RMSE_Pct", 4).alias("Reduccion_RMSE_Pct"), F.round("AmplitudBanda", 2).alias("AmplitudBanda"), "Prescripcion")


@query("coint_texts", with_ctes(*EC._EG_CTES) + f"SELECT par, round(p_value, 5) AS p_value, {compiled(COINTEGRATION, 'duckdb')} AS Diagnostico FROM tested")
def q_coint_texts(spark, d):
    """Long-run diagnosis of every pair of market series."""
    pairs = spark.createDataFrame(EC.PAIRS, "par string, serie_y string, serie_x string")
    eg = EC.engle_granger(EC.market_series(spark, d), pairs)
    return eg.select("par", F.round("p_value", 5).alias("p_value"), column(COINTEGRATION).alias("Diagnostico"))


@query("treasury_rule", f"SELECT CuentaID, {compiled(TREASURY, 'duckdb')} AS Regla FROM (SELECT CuentaID, SaldoEfectivoRealDiario AS Saldo, H, L FROM ({TR.KPIS_SQL}) k) s")
def q_treasury_rule(spark, d):
    """Rule of the cash manager per account: mean balance against the mean bands."""
    flows = B.flujos(spark, d, per_user=True)
    p = TR.miller_orr_path(flows, TR.miller_orr_params(flows, TR.market_rate(B.mercado(spark, d))))
    g = p.groupBy("CuentaID").agg(F.avg("SaldoEfectivoReal").alias("Saldo"), F.avg("BandaInferior_L").alias("L"), F.avg("BandaSuperior_H").alias("H"))
    return g.select("CuentaID", column(TREASURY).alias("Regla"))


# Names of the months.
MONTHS = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
_MONTH = "CASE Mes " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(MONTHS, 1)) + " END"


@query("seasonal_peak", with_ctes(B.ventas_sql(channel=False), SE.series_sql(), SE.seasonal_sql()) + f"""SELECT NombreMes, round(Indice, 8) AS Indice, {compiled(PEAK, 'duckdb')} AS Alerta FROM (
  SELECT {_MONTH} AS NombreMes, Indice FROM (SELECT s.Mes, round(s.swing / m.mean_trend + 1, 8) AS Indice FROM (SELECT serie, Mes, AVG(seasonal) AS swing FROM x GROUP BY 1, 2) s
  JOIN (SELECT serie, AVG(trend) AS mean_trend FROM x GROUP BY 1) m USING (serie) ORDER BY Indice DESC, Mes LIMIT 1) p) q""")
def q_seasonal_peak(spark, d):
    """The peak month of all sales, whatever is selected, and its warning."""
    index = SE.seasonal_index(SE.monthly_series(B.ventas(spark, d, channel=False)))
    top = index.orderBy(F.desc("indice_estacional"), "Mes").limit(1).select(F.expr(_MONTH).alias("NombreMes"), F.col("indice_estacional").alias("Indice"))
    return top.select("NombreMes", "Indice", column(PEAK).alias("Alerta"))
