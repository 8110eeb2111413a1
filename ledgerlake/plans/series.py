"""Time-series and econometric jobs on monthly sales series.

Series are (series id, month index t, y) DataFrames; every operator works
per series (``Window.partitionBy(series)``), so many series run in parallel
and one series is bounded by its number of months.

* seasonal_index: classical 2x12 centred moving average, detrend, mean
  swing per calendar month / mean trend + 1.
* forecast_features: lags 1/2/3/12, previous-3/12 rolling means, sin/cos of
  the month, trend; incomplete rows dropped.
* forecast_backtest: last-12 holdout; seasonal naive, trend + seasonal
  effects, drift and moving mean (closed forms by aggregates); RMSE/MAE/MAPE/R2/
  bias, share inside the 95 % band and rank; lag order by AIC; unit roots.
* price_elasticity: log-log panel of the domestic channels, SKU and
  calendar-month effects, HC1 standard error, global and per segment.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import norm_cdf
from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources import bridge as B


def monthly_series(ventas: DataFrame, by: str | None = None, complete: bool = True) -> DataFrame:
    """(serie, t, Anio, Mes, y): revenue per month.  With ``complete`` the last
    month counts only if the data reach its end (one month at most is left out)."""
    keys = [F.col(by).alias("serie")] if by else [F.lit("TOTAL").alias("serie")]
    g = materialise(ventas.groupBy(*keys, "Anio", "Mes").agg(F.sum("IngresosReales").cast("double").alias("y"),
                                                             F.max("Fecha").alias("hasta")))
    if complete:
        last = g.agg(F.max("hasta")).scalar()
        g = g.filter(F.last_day("hasta") <= last)
    return g.withColumn("t", F.col("Anio") * 12 + F.col("Mes")).drop("hasta")


def series_sql(by: str | None = None) -> str:
    key = by if by else "'TOTAL'"
    return f"""ms AS (SELECT {key} AS serie, Anio, Mes, CAST(SUM(IngresosReales) AS DOUBLE) AS y, Anio * 12 + Mes AS t
  FROM ventas GROUP BY 1, 2, 3
  HAVING make_date(Anio, Mes, 1) + INTERVAL 1 MONTH <= (SELECT max(Fecha) + INTERVAL 1 DAY FROM ventas))"""


def seasonal_index(series: DataFrame, digits: int = 8) -> DataFrame:
    w = Window.partitionBy("serie").orderBy("t")
    terms = [0.5 * F.lag("y", 6).over(w), 0.5 * F.lead("y", 6).over(w)]
    terms += [F.lag("y", k).over(w) for k in range(1, 6)] + [F.lead("y", k).over(w) for k in range(1, 6)]
    tr = terms[0]
    for t in terms[1:]:
        tr = tr + t
    x = series.withColumn("trend", (tr + F.col("y")) / 12.0).filter(F.col("trend").isNotNull())
    x = x.withColumn("seasonal", F.col("y") - F.col("trend"))
    mt = x.groupBy("serie").agg(F.avg("trend").alias("mean_trend"))
    sm = x.groupBy("serie", "Mes").agg(F.avg("seasonal").alias("swing"))
    return sm.join(mt, "serie").select("serie", "Mes",
                                       F.round(F.col("swing") / F.col("mean_trend") + 1, digits).alias("indice_estacional"))


def seasonal_sql() -> str:
    lags = " + ".join([f"lag(y, {k}) OVER w" for k in range(1, 6)] + [f"lead(y, {k}) OVER w" for k in range(1, 6)])
    return f"""tr AS (SELECT serie, Mes, y, (0.5 * lag(y, 6) OVER w + 0.5 * lead(y, 6) OVER w + {lags} + y) / 12.0 AS trend
  FROM ms WINDOW w AS (PARTITION BY serie ORDER BY t)),
x AS (SELECT serie, Mes, trend, y - trend AS seasonal FROM tr WHERE trend IS NOT NULL)"""


@query("seasonal_index", with_ctes(B.ventas_sql(channel=False), series_sql("Segmento"), seasonal_sql()) + """SELECT s.serie, s.Mes,
  round(s.swing / m.mean_trend + 1, 8) AS indice_estacional
FROM (SELECT serie, Mes, AVG(seasonal) AS swing FROM x GROUP BY serie, Mes) s
JOIN (SELECT serie, AVG(trend) AS mean_trend FROM x GROUP BY serie) m ON s.serie = m.serie""")
def q_seasonal_index(spark, d):
    """Seasonal index per product segment (one series each)."""
    return seasonal_index(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))


def forecast_features(series: DataFrame) -> DataFrame:
    w = Window.partitionBy("serie").orderBy("t")
    x = series
    for k in (1, 2, 3, 12):
        x = x.withColumn(f"lag_{k}", F.lag("y", k).over(w))
    for n in (3, 12):
        wr = w.rowsBetween(-n, -1)
        x = x.withColumn(f"rm_{n}", F.when(F.count("y").over(wr) == n, F.avg("y").over(wr)))
    x = (x.withColumn("mes_sin", F.round(F.sin(2 * math.pi * F.col("Mes") / 12), 10))
          .withColumn("mes_cos", F.round(F.cos(2 * math.pi * F.col("Mes") / 12), 10))
          .withColumn("tendencia", F.row_number().over(w)))
    return x.na.drop(subset=["lag_1", "lag_2", "lag_3", "lag_12", "rm_3", "rm_12"])


@query("forecast_features", with_ctes(B.ventas_sql(channel=False), series_sql()) + f"""SELECT * FROM (
  SELECT serie, Anio, Mes, y, t, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 3) OVER w AS lag_3,
         lag(y, 12) OVER w AS lag_12,
         CASE WHEN count(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
              THEN avg(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS rm_3,
         CASE WHEN count(y) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) = 12
              THEN avg(y) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) END AS rm_12,
         round(sin(2 * pi() * Mes / 12), 10) AS mes_sin, round(cos(2 * pi() * Mes / 12), 10) AS mes_cos,
         row_number() OVER w AS tendencia
  FROM ms WINDOW w AS (PARTITION BY serie ORDER BY t)) f
WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND lag_12 IS NOT NULL
  AND rm_3 IS NOT NULL AND rm_12 IS NOT NULL""")
def q_forecast_features(spark, d):
    return forecast_features(monthly_series(B.ventas(spark, d, channel=False)))


# Names of the candidates; quantile of the band; advice on the plan.
CANDIDATES = ["Seasonal_Naive", "Tendencia_Estacional", "Naive_Deriva", "Media_Movil_12"]
BAND = 1.96
ADVICE = ("Usar el modelo de mayor precision", "Mantener el benchmark estacional")


def forecast_backtest(series: DataFrame, horizon: int = 12) -> DataFrame:
    """Holdout = last ``horizon`` months of each series.  Candidates: value twelve
    months earlier, linear trend + mean seasonal effect, last value + mean drift,
    mean of the last twelve months; all closed forms of the training months.
    Metrics per series x model, share of months inside the 95 % band (from the
    training residuals of the trend model), rank by RMSE (1 = winner)."""
    w = Window.partitionBy("serie").orderBy(F.col("t").desc())
    x = series.withColumn("_k", F.row_number().over(w)).withColumn("test", F.col("_k") <= horizon)
    x = x.withColumn("snaive", F.lag("y", 12).over(Window.partitionBy("serie").orderBy("t")))
    tr = x.filter(~F.col("test"))
    last = F.max(F.struct("t", "y"))
    fit = tr.groupBy("serie").agg(
        F.regr_slope("y", "t").alias("b"), F.regr_intercept("y", "t").alias("a"), last["t"].alias("t1"), last["y"].alias("y1"),
        F.min(F.struct("t", "y")).alias("f"), F.avg(F.when(F.col("_k") <= horizon + 12, F.col("y"))).alias("mm"))
    fit = fit.withColumn("drift", (F.col("y1") - F.col("f.y")) / (F.col("t1") - F.col("f.t"))).drop("f")
    line = F.col("a") + F.col("b") * F.col("t")
    # one row per series and calendar month
    seas = tr.join(fit, "serie").groupBy("serie", "Mes").agg(F.avg(F.col("y") - line).alias("s"))
    sd = tr.join(fit, "serie").join(seas, ["serie", "Mes"]).groupBy("serie").agg(F.sqrt(F.avg((F.col("y") - line - F.col("s")) ** 2)).alias("sd"))
    te = x.filter("test").join(fit, "serie").join(seas, ["serie", "Mes"], "left").join(sd, "serie")
    te = te.select("serie", "t", "y", "sd", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in CANDIDATES]), F.array(
        F.col("snaive"), line + F.coalesce("s", F.lit(0.0)), F.col("y1") + F.col("drift") * (F.col("t") - F.col("t1")), F.col("mm")))).alias("Modelo", "yhat"))
    e = F.col("yhat") - F.col("y")
    m = te.groupBy("serie", "Modelo").agg(
        F.sqrt(F.avg(e ** 2)).alias("RMSE"), F.avg(F.abs(e)).alias("MAE"), (F.avg(F.abs(e / F.col("y"))) * 100).alias("MAPE_Pct"),
        (1 - F.sum(e ** 2) / (F.count("y") * F.var_pop("y"))).alias("R2_Score"), F.avg(e).alias("Sesgo"),
        F.avg((F.abs(e) <= BAND * F.col("sd")).cast("double")).alias("EnBanda"))
    r = m.withColumn("Ranking_Precision", F.rank().over(Window.partitionBy("serie").orderBy("RMSE")))
    return r.select("serie", "Modelo", *[F.round(c, n).alias(c) for c, n in (("RMSE", 2), ("MAE", 2), ("MAPE_Pct", 4), ("R2_Score", 4), ("Sesgo", 2), ("EnBanda", 6))],
                    "Ranking_Precision")


_BACKTEST_CTES = [B.ventas_sql(channel=False), series_sql("Segmento"), """x AS (
  SELECT *, row_number() OVER (PARTITION BY serie ORDER BY t DESC) AS k, max(t) OVER (PARTITION BY serie) AS tz FROM ms)""",
    """tr AS (SELECT * FROM x WHERE k > 12)""",
    """fit AS (SELECT serie, covar_pop(y, t) / var_pop(t) AS b, avg(y) - covar_pop(y, t) / var_pop(t) * avg(t) AS a, max(t) AS t1, arg_max(y, t) AS y1,
         (arg_max(y, t) - arg_min(y, t)) / (max(t) - min(t)) AS drift, avg(y) FILTER (WHERE k <= 24) AS mm FROM tr GROUP BY serie)""",
    """seas AS (SELECT serie, Mes, avg(y - a - b * t) AS s FROM tr JOIN fit USING (serie) GROUP BY 1, 2)""",
    """sd AS (SELECT serie, sqrt(avg((y - a - b * t - s) ^ 2)) AS sd FROM tr JOIN fit USING (serie) JOIN seas USING (serie, Mes) GROUP BY 1)""",
    """te AS (SELECT h.serie, h.t, h.y, sd, o.y AS sn, a + b * h.t + COALESCE(s, 0) AS ts, y1 + drift * (h.t - t1) AS nd, mm
         FROM x h JOIN fit USING (serie) JOIN sd USING (serie) LEFT JOIN seas ON seas.serie = h.serie AND seas.Mes = h.Mes
         LEFT JOIN ms o ON o.serie = h.serie AND o.t = h.t - 12 WHERE h.k <= 12)""",
    f"""lng AS (SELECT serie, y, sd, unnest({CANDIDATES}) AS Modelo, unnest([sn, ts, nd, mm]) AS yhat FROM te)""",
    f"""m AS (SELECT serie, Modelo, sqrt(avg((y - yhat) ^ 2)) AS RMSE, avg(abs(y - yhat)) AS MAE, avg(abs((y - yhat) / y)) * 100 AS MAPE_Pct,
                  1 - sum((y - yhat) ^ 2) / (count(y) * var_pop(y)) AS R2_Score, avg(yhat - y) AS Sesgo,
                  avg(CASE WHEN abs(yhat - y) <= {BAND} * sd THEN 1.0 ELSE 0.0 END) AS EnBanda FROM lng GROUP BY 1, 2)"""]


@query("forecast_backtest", with_ctes(*_BACKTEST_CTES) + """SELECT serie, Modelo, round(RMSE, 2) AS RMSE, round(MAE, 2) AS MAE,
  round(MAPE_Pct, 4) AS MAPE_Pct, round(R2_Score, 4) AS R2_Score, round(Sesgo, 2) AS Sesgo, round(EnBanda, 6) AS EnBanda,
  CAST(rank() OVER (PARTITION BY serie ORDER BY RMSE) AS INT) AS Ranking_Precision FROM m""")
def q_forecast_backtest(spark, d):
    return forecast_backtest(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))


@query("demand_plan_advice", with_ctes(*_BACKTEST_CTES) + f"""SELECT serie, arg_min(Modelo, RMSE) AS Ganador, round(min(RMSE), 2) AS RMSE_Ganador,
  round(max(RMSE) FILTER (WHERE Modelo = '{CANDIDATES[0]}'), 2) AS RMSE_Benchmark,
  CASE WHEN min(RMSE) < max(RMSE) FILTER (WHERE Modelo = '{CANDIDATES[0]}') THEN '{ADVICE[0]}' ELSE '{ADVICE[1]}' END AS Consejo FROM m GROUP BY serie""")
def q_demand_plan_advice(spark, d):
    """Winner of the backtest per series against the seasonal benchmark."""
    m = forecast_backtest(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))
    best = F.min(F.struct("RMSE", "Modelo"))
    bench = F.max(F.when(F.col("Modelo") == CANDIDATES[0], F.col("RMSE")))
    return m.groupBy("serie").agg(best["Modelo"].alias("Ganador"), best["RMSE"].alias("RMSE_Ganador"), bench.alias("RMSE_Benchmark")).withColumn(
        "Consejo", F.when(F.col("RMSE_Ganador") < F.col("RMSE_Benchmark"), ADVICE[0]).otherwise(ADVICE[1]))


# Lags of the order candidates: one regressor each, besides the intercept.
ORDERS = (1, 2, 3, 12)


@query("order_selection", with_ctes(B.ventas_sql(channel=False), series_sql("Segmento"), f"""c AS (
  SELECT a.serie, p, a.y, b.y AS x FROM ms a CROSS JOIN (VALUES {', '.join(f'({p})' for p in ORDERS)}) o(p) JOIN ms b ON b.serie = a.serie AND b.t = a.t - p
  WHERE a.t - {max(ORDERS)} >= (SELECT min(t) FROM ms z WHERE z.serie = a.serie))""", """f AS (
  SELECT serie, p, count(*) AS n, (sum(y * y) - sum(y) ^ 2 / count(*)) - (sum(x * y) - sum(x) * sum(y) / count(*)) ^ 2 / (sum(x * x) - sum(x) ^ 2 / count(*)) AS sse FROM c GROUP BY 1, 2)""") + """SELECT serie, p AS Rezago, n AS Observaciones,
  round(n * ln(sse / n) + 4, 4) AS AIC, round(n * ln(sse / n) + 4, 4) = min(round(n * ln(sse / n) + 4, 4)) OVER (PARTITION BY serie) AS Elegido FROM f""")
def q_order_selection(spark, d):
    """AIC = n ln(sse / n) + 2 k of the regression on one lag, over the months that
    all candidates have; the smallest is chosen."""
    s = monthly_series(B.ventas(spark, d, channel=False), "Segmento")
    w = Window.partitionBy("serie").orderBy("t").rangeBetween
    lagged = [F.max("y").over(w(-p, -p)) for p in ORDERS]  # by month number, so a missing month is no lag
    first = F.min("t").over(Window.partitionBy("serie"))
    x = s.withColumn("all", F.map_from_arrays(F.array(*[F.lit(p) for p in ORDERS]), F.array(*lagged))).withColumn("first", first)
    x = x.filter(F.col("t") - max(ORDERS) >= F.col("first")).select("serie", "y", F.explode("all").alias("Rezago", "x")).filter("x is not null")
    g = x.groupBy("serie", "Rezago").agg(F.count(F.lit(1)).alias("Observaciones"), (F.regr_syy("y", "x") * (1 - F.regr_r2("y", "x"))).alias("sse"))
    g = g.withColumn("AIC", F.round(F.col("Observaciones") * F.log(F.col("sse") / F.col("Observaciones")) + 4, 4))
    return g.select("serie", "Rezago", "Observaciones", "AIC", (F.col("AIC") == F.min("AIC").over(Window.partitionBy("serie"))).alias("Elegido"))


# 5 % critical values (constant; residuals of two series) and labels.
ADF_CRITICAL, EG_CRITICAL = -2.86, -3.34
COINT = ("RELACION DE LARGO PLAZO CONFIRMADA", "AUSENCIA DE COINTEGRACION", "Analisis de cointegracion no disponible")


def _slope_t(y, x):
    """t statistic of a slope from the moments of one regression."""
    n = F.regr_count(y, x)
    return F.regr_slope(y, x) / F.sqrt(F.regr_syy(y, x) * (1 - F.regr_r2(y, x)) / (n - 2) / F.regr_sxx(y, x))


def dickey_fuller(series: DataFrame, value: str = "y") -> DataFrame:
    """(serie, estadistico): t of the lagged level in the regression of the change
    on it with a constant, for many series at once (window lags and moments)."""
    w = Window.partitionBy("serie").orderBy("t")
    x = series.withColumn("_l", F.lag(value).over(w)).withColumn("_d", F.col(value) - F.col("_l")).filter("_l is not null")
    return x.groupBy("serie").agg(_slope_t("_d", "_l").alias("estadistico"))


_LOGS_SQL = """lg AS (SELECT Segmento AS serie, Anio * 12 + Mes AS t, ln(SUM(VolumenReal)::DOUBLE) AS q, ln(SUM(IngresosReales)::DOUBLE / SUM(VolumenReal)::DOUBLE) AS p
  FROM ventas GROUP BY 1, 2)"""


def _df_sql(name: str, src: str, v: str) -> str:
    return f"""{name} AS (
  SELECT serie, sxy / sxx / sqrt((syy - sxy ^ 2 / sxx) / (n - 2) / sxx) AS st FROM (
    SELECT serie, count(*) AS n, sum(l * d) - sum(l) * sum(d) / count(*) AS sxy, sum(l * l) - sum(l) ^ 2 / count(*) AS sxx, sum(d * d) - sum(d) ^ 2 / count(*) AS syy
    FROM (SELECT serie, {v} - lag({v}) OVER w AS d, lag({v}) OVER w AS l FROM {src} WINDOW w AS (PARTITION BY serie ORDER BY t)) z WHERE l IS NOT NULL GROUP BY serie) m)"""


@query("unit_root_cointegration", with_ctes(B.ventas_sql(channel=False), _LOGS_SQL, """eg AS (
  SELECT serie, t, q - avg(q) OVER s - (avg(q * p) OVER s - avg(q) OVER s * avg(p) OVER s) / (avg(p * p) OVER s - avg(p) OVER s ^ 2) * (p - avg(p) OVER s) AS e
  FROM lg WINDOW s AS (PARTITION BY serie))""", _df_sql("a", "lg", "q"), _df_sql("b", "lg", "p"), _df_sql("c", "eg", "e")) + f"""SELECT serie, round(a.st, 6) AS ADF_Volumen, round(b.st, 6) AS ADF_Precio,
  round(c.st, 6) AS EngleGranger, a.st < {ADF_CRITICAL} AS VolumenEstacionario, b.st < {ADF_CRITICAL} AS PrecioEstacionario,
  CASE WHEN c.st IS NULL THEN '{COINT[2]}' WHEN c.st < {EG_CRITICAL} THEN '{COINT[0]}' ELSE '{COINT[1]}' END AS Diagnostico
FROM a JOIN b USING (serie) JOIN c USING (serie)""")
def q_unit_root_cointegration(spark, d):
    """Per segment: unit-root statistics of ln volume and ln price, and of the
    residual of one on the other."""
    v = B.ventas(spark, d, channel=False).groupBy(F.col("Segmento").alias("serie"), (F.col("Anio") * 12 + F.col("Mes")).alias("t")).agg(
        F.log(F.sum("VolumenReal").cast("double")).alias("q"), F.log(F.sum("IngresosReales").cast("double") / F.sum("VolumenReal").cast("double")).alias("p"))
    v = materialise(v)
    fit = v.groupBy("serie").agg(F.regr_slope("q", "p").alias("b"), F.regr_intercept("q", "p").alias("a"))  # one row per series
    res = v.join(fit, "serie").withColumn("e", F.col("q") - F.col("a") - F.col("b") * F.col("p"))
    stat = lambda df, c, name: dickey_fuller(df, c).select("serie", F.col("estadistico").alias(name))
    j = stat(v, "q", "a_").join(stat(v, "p", "b_"), "serie").join(stat(res, "e", "c_"), "serie")
    text = F.when(F.col("c_").isNull(), COINT[2]).when(F.col("c_") < EG_CRITICAL, COINT[0]).otherwise(COINT[1])
    return j.select("serie", F.round("a_", 6).alias("ADF_Volumen"), F.round("b_", 6).alias("ADF_Precio"), F.round("c_", 6).alias("EngleGranger"),
                    (F.col("a_") < ADF_CRITICAL).alias("VolumenEstacionario"), (F.col("b_") < ADF_CRITICAL).alias("PrecioEstacionario"), text.alias("Diagnostico"))


# ---------------------------------------------------------------------------
# Panel price elasticity
# ---------------------------------------------------------------------------

MONTHS = list(range(2, 13))


def elasticity_panel(ventas: DataFrame, export_channel: str = B.EXPORT_SEGMENT) -> DataFrame:
    """SKU x month panel of the domestic channels: ln volume and ln mean price."""
    g = (ventas.filter(F.col("CanalVenta") != export_channel).groupBy("ProductoID", "Segmento", "Anio", "Mes")
         .agg(F.sum("VolumenReal").cast("double").alias("q"), F.sum("IngresosReales").cast("double").alias("r")))
    return g.filter("q > 0 and r > 0").select("ProductoID", "Segmento", "Mes", F.log(F.col("r") / F.col("q")).alias("x"), F.log("q").alias("y"))


def _solve(rows: list) -> list[dict]:
    """Per scope, from the sums of products of (month dummies, x, y) within SKUs:
    coefficients of x and y on the dummies, slope of y on x given them, and the
    number of fitted parameters."""
    out = []
    size = len(MONTHS) + 2
    for r in rows:
        gram = np.zeros((size, size))
        gram[np.triu_indices(size)] = r["gram"]
        gram = gram + gram.T - np.diag(np.diag(gram))
        d, dx, dy = gram[:-2, :-2], gram[:-2, -2], gram[:-2, -1]
        inverse = np.linalg.pinv(d, rcond=1e-10, hermitian=True)
        on_x, on_y = inverse @ dx, inverse @ dy
        sxx, sxy, syy = gram[-2, -2] - dx @ on_x, gram[-2, -1] - dx @ on_y, gram[-1, -1] - dy @ on_y
        k = r["skus"] + int(np.linalg.matrix_rank(d, tol=1e-8 * max(1.0, r["n"]), hermitian=True)) + 1
        known = sxx > 1e-9 * max(gram[-2, -2], 1e-300) and r["n"] > k
        out.append({"Segmento": r["Segmento"], "n": r["n"], "k": k, "sst": r["sst"], "sxx": float(sxx), "on_x": on_x.tolist(), "on_y": on_y.tolist(),
                    "beta": float(sxy / sxx) if known else None})
    return out


_FITTED = {"Segmento": "string", "n": "long", "k": "long", "sst": "double", "sxx": "double", "on_x": "array<double>", "on_y": "array<double>", "beta": "double"}


def price_elasticity(panel: DataFrame) -> DataFrame:
    """Slope of ln volume on ln price with SKU and calendar-month effects, HC1
    error, normal p-value and R2, over all SKUs (GLOBAL) and per segment.

    Products around SKU means follow from one row of sums per SKU (rows, x, y by
    month), so the panel is summed once and the 13 x 13 products are taken over
    SKUs, not over rows; added up they give the fits of the segments and the
    global one, a row each, which are solved on the driver.  This is exact on any panel, balanced or not.
    A second pass over the panel sums the squared residuals of both fits of a row.  Where the parameters use up the
    observations, slope and error are null."""
    panel = materialise(panel)
    x, y = F.col("x"), F.col("y")
    by_month = [F.sum(F.when(F.col("Mes") == m, v).otherwise(0.0)).alias(f"{n}{m}") for n, v in (("c", F.lit(1.0)), ("sx", x), ("sy", y)) for m in MONTHS]
    skus = panel.groupBy("ProductoID", "Segmento").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"),
        F.sum(x * y).alias("sxy"), F.sum(y * y).alias("syy"), *by_month)
    n = F.col("n")
    c = {m: F.col(f"c{m}") for m in MONTHS}

    def product(a, b):
        if a in c and b in c:
            return (c[a] if a == b else F.lit(0.0)) - c[a] * c[b] / n
        if a in c:
            return F.col(f"s{b}{a}") - c[a] * F.col(f"s{b}") / n
        return F.col(f"s{a}{b}") - F.col(f"s{a}") * F.col(f"s{b}") / n

    names = [*MONTHS, "x", "y"]
    sums = skus.groupingSets([[F.col("Segmento")], []], F.col("Segmento")).agg(  # one row per segment and one for all
        F.array(*[F.sum(product(a, b)) for i, a in enumerate(names) for b in names[i:]]).alias("gram"), F.sum(n).cast("long").alias("n"),
        F.count(F.lit(1)).alias("skus"), (F.sum("syy") - F.sum("sy") ** 2 / F.sum(n)).alias("sst"))
    sums = sums.withColumn("Segmento", F.coalesce("Segmento", F.lit("GLOBAL"))).select("Segmento", "gram", "n", "skus", "sst")
    fits = _solve(sums.collect())  # one row per segment, and one
    spark = panel.sparkSession
    fitted = F.broadcast(spark.createDataFrame([tuple(f[c] for c in _FITTED) for f in fits], ", ".join(f"{c} {t}" for c, t in _FITTED.items())))
    # a residual is the value less its month's effect less a constant of the SKU
    sku = Window.partitionBy("ProductoID", "Segmento")
    month = lambda e: F.coalesce(F.get(e, F.col("Mes") - 2), F.lit(0.0))
    freed = lambda v, e: (v - month(e)) - F.avg(v - month(e)).over(sku)
    whole = next((f for f in fits if f["Segmento"] == "GLOBAL"), {"on_x": [], "on_y": [], "beta": None})
    literal = lambda values: F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")
    own = panel.join(fitted.select("Segmento", "on_x", "on_y", "beta"), "Segmento")
    own = own.select("Segmento", "beta", freed(x, F.col("on_x")).alias("xr"), freed(y, F.col("on_y")).alias("yr"),
                     freed(x, literal(whole["on_x"])).alias("xg"), freed(y, literal(whole["on_y"])).alias("yg"))
    error, error_g = F.col("yr") - F.col("beta") * F.col("xr"), F.col("yg") - F.lit(whole["beta"]).cast("double") * F.col("xg")
    squares = own.groupBy("Segmento").agg(F.sum((F.col("xr") * error) ** 2).alias("meat"), F.sum(error ** 2).alias("sse"),
                                          F.sum((F.col("xg") * error_g) ** 2).alias("meat_g"), F.sum(error_g ** 2).alias("sse_g"))
    squares = squares.select(F.inline(F.array(F.struct("Segmento", "meat", "sse"), F.struct(F.lit("GLOBAL").alias("Segmento"), F.col("meat_g").alias("meat"), F.col("sse_g").alias("sse")))))
    squares = squares.groupBy("Segmento").agg(F.sum("meat").alias("meat"), F.sum("sse").alias("sse"))
    j = squares.join(fitted, "Segmento")
    se = F.sqrt(F.col("meat") * F.col("n") / (F.col("n") - F.col("k"))) / F.col("sxx")
    p = 2 * (1 - norm_cdf(F.abs(F.col("beta") / se)))
    return j.select("Segmento", F.round("beta", 6).alias("Beta_Elasticidad"), F.round(F.when(F.col("beta").isNotNull(), se), 6).alias("ErrorEstandar"),
                    F.round(F.when(F.col("beta").isNotNull(), p), 5).alias("PValue"),
                    F.round(F.when(F.col("beta").isNotNull(), 1 - F.col("sse") / F.col("sst")), 6).alias("R2"), F.col("n").alias("NObs"),
                    F.coalesce(p < 0.05, F.lit(False)).alias("Significativo"))


def _ncdf_sql(x: str) -> str:
    z = f"(abs({x}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.3275911 * {z}))"
    poly = f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))))"
    erf = f"(1.0 - {poly} * exp(-{z} * {z}))"
    return f"(CASE WHEN {x} >= 0 THEN 0.5 * (1.0 + {erf}) ELSE 0.5 * (1.0 - {erf}) END)"


#: Rounds of alternating projections in the oracle; it partials the effects out by
#: subtracting SKU means and month means in turn, which tends to the same residuals.
_ROUNDS = 60

_ELASTICITY_CTES = [B.ventas_sql(), f"""panel AS (
  SELECT ProductoID, Segmento, Mes, ln(SUM(IngresosReales)::DOUBLE / SUM(VolumenReal)::DOUBLE) AS x, ln(SUM(VolumenReal)::DOUBLE) AS y
  FROM ventas WHERE CanalVenta <> '{B.EXPORT_SEGMENT}' GROUP BY ProductoID, Segmento, Anio, Mes HAVING SUM(VolumenReal) > 0 AND SUM(IngresosReales) > 0)""",
    """scoped AS (SELECT 'GLOBAL' AS scope, * FROM panel UNION ALL SELECT Segmento, * FROM panel)""",
    f"""proj AS (
  SELECT 0 AS i, scope, ProductoID, Mes, x, y, y AS y0, row_number() OVER () AS id FROM scoped
  UNION ALL
  SELECT i + 1, scope, ProductoID, Mes, x1 - avg(x1) OVER (PARTITION BY scope, Mes), y1 - avg(y1) OVER (PARTITION BY scope, Mes), y0, id
  FROM (SELECT *, x - avg(x) OVER (PARTITION BY scope, ProductoID) AS x1, y - avg(y) OVER (PARTITION BY scope, ProductoID) AS y1 FROM proj WHERE i < {_ROUNDS}) s)""",
    f"""fin AS (
  SELECT scope, ProductoID, Mes, x - avg(x) OVER (PARTITION BY scope, ProductoID) AS x, y - avg(y) OVER (PARTITION BY scope, ProductoID) AS y, y0
  FROM proj WHERE i = {_ROUNDS})""",
    """fit AS (SELECT scope, sum(x * y) / sum(x * x) AS beta, sum(x * x) AS sxx, count(*) AS n,
         count(DISTINCT ProductoID) + count(DISTINCT Mes) AS k, var_pop(y0) * count(*) AS sst FROM fin GROUP BY scope)""",
    """err AS (SELECT scope, sum((x * (y - beta * x)) ^ 2) AS meat, sum((y - beta * x) ^ 2) AS sse FROM fin JOIN fit USING (scope) GROUP BY scope)""",
    """el AS (SELECT scope, n, CASE WHEN n > k THEN beta END AS beta, sqrt(meat * n / nullif(n - k, 0)) / sxx AS se, 1 - sse / sst AS r2, n > k AS known FROM fit JOIN err USING (scope))"""]

_ELASTICITY_SQL = with_ctes(*_ELASTICITY_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT scope AS Segmento, round(beta, 6) AS Beta_Elasticidad,
  CASE WHEN known THEN round(se, 6) END AS ErrorEstandar, CASE WHEN known THEN round(2 * (1 - {_ncdf_sql('abs(beta / se)')}), 5) END AS PValue,
  CASE WHEN known THEN round(r2, 6) END AS R2, n AS NObs, COALESCE(2 * (1 - {_ncdf_sql('abs(beta / se)')}) < 0.05, false) AS Significativo
FROM el"""


@query("price_elasticity", _ELASTICITY_SQL)
def q_price_elasticity(spark, d):
    return price_elasticity(elasticity_panel(B.ventas(spark, d)))


# Labels of the order check and limits of the pricing strategy.
ORDER_UNKNOWN, ORDER_OK, ORDER_BROKEN = "NO EVALUABLE", "OK", "OBSERVACION"
INELASTIC_ABOVE, ELASTIC_BELOW = -0.005, -0.010
STRATEGY = {"sin_dato": "Seleccione un segmento para evaluar la respuesta de precios", "inelastica": "DEMANDA INELASTICA",
            "elastica": "DEMANDA ELASTICA", "moderada": "ELASTICIDAD MODERADA"}


def economic_order_check(betas: DataFrame, elastic: list[str], inelastic: list[str]) -> DataFrame:
    """One row: whether the most negative slope of the segments expected to be
    elastic lies below the highest of those expected not to be."""
    pick = lambda names, f: f(F.when(F.col("Segmento").isin(names), F.col("Beta_Elasticidad")))
    g = betas.agg(pick(elastic, F.min).alias("BetaElastica"), pick(inelastic, F.max).alias("BetaInelastica"))
    known = F.col("BetaElastica").isNotNull() & F.col("BetaInelastica").isNotNull()
    return g.withColumn("Chequeo", F.when(~known, ORDER_UNKNOWN).when(F.col("BetaElastica") < F.col("BetaInelastica"), ORDER_OK).otherwise(ORDER_BROKEN))


def elasticity_strategy(betas: DataFrame, premium: list[str], entry: list[str]) -> DataFrame:
    beta, seg = F.col("Beta_Elasticidad"), F.col("Segmento")
    kind = (F.when(beta.isNull(), STRATEGY["sin_dato"]).when(seg.isin(premium) | (beta > INELASTIC_ABOVE), STRATEGY["inelastica"])
            .when(seg.isin(entry) | (beta < ELASTIC_BELOW), STRATEGY["elastica"]).otherwise(STRATEGY["moderada"]))
    text = F.when(beta.isNull(), kind).otherwise(F.format_string("%s (%s, beta=%.4f)", kind, seg, beta))
    return betas.select("Segmento", "Beta_Elasticidad", kind.alias("Estrategia"), text.alias("Texto"))


ELASTIC, INELASTIC = ["ECONOMY", "STANDARD"], ["PROMO", "MEDIUM"]


@query("economic_order_check", with_ctes(*_ELASTICITY_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT BetaElastica, BetaInelastica,
  CASE WHEN BetaElastica IS NULL OR BetaInelastica IS NULL THEN '{ORDER_UNKNOWN}' WHEN BetaElastica < BetaInelastica THEN '{ORDER_OK}' ELSE '{ORDER_BROKEN}' END AS Chequeo
FROM (SELECT min(round(beta, 6)) FILTER (WHERE scope IN ('{ELASTIC[0]}', '{ELASTIC[1]}')) AS BetaElastica,
             max(round(beta, 6)) FILTER (WHERE scope IN ('{INELASTIC[0]}', '{INELASTIC[1]}')) AS BetaInelastica FROM el) t""")
def q_economic_order_check(spark, d):
    panel = elasticity_panel(B.ventas(spark, d))
    return economic_order_check(price_elasticity(panel), ELASTIC, INELASTIC)


@query("elasticity_strategy", with_ctes(*_ELASTICITY_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT Segmento, Beta_Elasticidad, Estrategia,
  CASE WHEN Beta_Elasticidad IS NULL THEN Estrategia ELSE printf('%s (%s, beta=%.4f)', Estrategia, Segmento, Beta_Elasticidad) END AS Texto FROM (
  SELECT scope AS Segmento, round(beta, 6) AS Beta_Elasticidad, CASE WHEN beta IS NULL THEN '{STRATEGY['sin_dato']}'
    WHEN scope IN ('{INELASTIC[0]}', '{INELASTIC[1]}') OR round(beta, 6) > {INELASTIC_ABOVE} THEN '{STRATEGY['inelastica']}'
    WHEN scope IN ('{ELASTIC[0]}', '{ELASTIC[1]}') OR round(beta, 6) < {ELASTIC_BELOW} THEN '{STRATEGY['elastica']}' ELSE '{STRATEGY['moderada']}' END AS Estrategia FROM el) t""")
def q_elasticity_strategy(spark, d):
    panel = elasticity_panel(B.ventas(spark, d))
    return elasticity_strategy(price_elasticity(panel), INELASTIC, ELASTIC)


@query("price_series", with_ctes(B.ventas_sql()) + f"""SELECT Anio, Mes,
  round(avg(CAST(IngresosReales AS DOUBLE) / CAST(VolumenReal AS DOUBLE)) FILTER (WHERE CanalVenta = '{B.EXPORT_SEGMENT}'), 6) AS PrecioExportacion,
  round(CAST(SUM(IngresosReales) FILTER (WHERE CanalVenta <> '{B.EXPORT_SEGMENT}') AS DOUBLE)
        / CAST(SUM(VolumenReal) FILTER (WHERE CanalVenta <> '{B.EXPORT_SEGMENT}') AS DOUBLE), 6) AS PrecioDomestico
FROM ventas WHERE VolumenReal <> 0 GROUP BY Anio, Mes""")
def q_price_series(spark, d):
    """Monthly prices: export as the simple mean of the unit prices, domestic
    weighted by volume."""
    v = B.ventas(spark, d, product=False).filter("VolumenReal <> 0")
    export = F.col("CanalVenta") == B.EXPORT_SEGMENT
    money, volume = F.col("IngresosReales"), F.col("VolumenReal")
    return v.groupBy("Anio", "Mes").agg(
        F.round(F.avg(F.when(export, money.cast("double") / volume.cast("double"))), 6).alias("PrecioExportacion"),
        F.round(F.sum(F.when(~export, money)).cast("double") / F.sum(F.when(~export, volume)).cast("double"), 6).alias("PrecioDomestico"))


@query("seasonal_compare", with_ctes(B.ventas_sql(channel=False), series_sql("Segmento"), seasonal_sql(), """own AS (
  SELECT s.serie, s.Mes, s.swing / m.mean_trend + 1 AS idx
  FROM (SELECT serie, Mes, AVG(seasonal) AS swing FROM x GROUP BY 1, 2) s JOIN (SELECT serie, AVG(trend) AS mean_trend FROM x GROUP BY 1) m USING (serie))""",
    """ext AS (SELECT Mes, AVG(idx) AS ref FROM own GROUP BY Mes)""") + """SELECT serie, round(max(abs(idx - ref)), 8) AS DiferenciaMaxima,
  round(avg(abs(idx - ref)), 8) AS DiferenciaMedia, round(corr(idx, ref), 8) AS Correlacion,
  CAST(arg_max(Mes, idx) AS INT) AS MesPico, round(max(idx), 8) AS IndicePico
FROM own JOIN ext USING (Mes) GROUP BY serie""")
def q_seasonal_compare(spark, d):
    """Each series' seasonal index against the mean index of all: largest and
    mean difference, correlation, and the peak month (``seasonal_peak``)."""
    own = seasonal_index(monthly_series(B.ventas(spark, d, channel=False), "Segmento"), 15)
    ref = own.groupBy("Mes").agg(F.avg("indice_estacional").alias("ref"))  # twelve rows
    gap = F.abs(F.col("indice_estacional") - F.col("ref"))
    peak = F.max(F.struct("indice_estacional", "Mes"))
    return own.join(F.broadcast(ref), "Mes").groupBy("serie").agg(
        F.round(F.max(gap), 8).alias("DiferenciaMaxima"), F.round(F.avg(gap), 8).alias("DiferenciaMedia"),
        F.round(F.corr("indice_estacional", "ref"), 8).alias("Correlacion"), peak["Mes"].cast("int").alias("MesPico"),
        F.round(peak["indice_estacional"], 8).alias("IndicePico"))
