"""Unit roots, cointegration, autoregressive forecasts and their order for many
series, on :mod:`ledgerlake.operators.regression`."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.loess import decompose, decompose_sql
from ledgerlake.operators.regression import SURFACE, adf, adf_sql, fit, matrix, ols_sql, products, solved, unit_root_p
from ledgerlake.plans.series import _ncdf_sql, monthly_series, series_sql
from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources import bridge as B

ALPHA = 0.05
#: Names of the orders of integration.
ORDERS = ("I(0)", "I(1)", "I(2)+")


def _p_sql(stat: str, series: int) -> str:
    s = SURFACE[series]
    poly = lambda c: " + ".join(f"{v} * pow({stat}, {k})" for k, v in enumerate(c))
    return (f"CASE WHEN {stat} IS NULL THEN NULL WHEN {stat} > {s['most']} THEN 1.0 WHEN {stat} < {s['least']} THEN 0.0 "
            f"WHEN {stat} <= {s['star']} THEN {_ncdf_sql('(' + poly(s['small']) + ')')} ELSE {_ncdf_sql('(' + poly(s['large']) + ')')} END")


# ---------------------------------------------------------------------------
# Order of integration
# ---------------------------------------------------------------------------

def integration_order(series: DataFrame, max_lag: int = 12, alpha: float = ALPHA) -> DataFrame:
    """Per series (serie, t, y): n, the tests of the levels and of the changes (rezagos, estadistico,
    p_value each) and the order: I(0) if the levels reject a unit root, I(1) if the changes do, else I(2)+.
    Null where neither decides for want of a statistic."""
    w = Window.partitionBy("serie").orderBy("t")
    levels = series.where("y IS NOT NULL").select("serie", "t", F.col("y").cast("double").alias("y"))
    changes = levels.withColumn("y", F.col("y") - F.lag("y").over(w)).where("y IS NOT NULL")
    both = levels.withColumn("paso", F.lit(0)).unionByName(changes.withColumn("paso", F.lit(1)))
    tests = adf(both, ["serie", "paso"], max_lag=max_lag).withColumn("p_value", unit_root_p(F.col("estadistico")))
    pick = lambda c, k, name: F.max(F.when(F.col("paso") == k, F.col(c))).alias(name)
    out = tests.groupBy("serie").agg(pick("n", 0, "n"), *[pick(c, k, f"{c}_{name}") for k, name in ((0, "nivel"), (1, "cambio"))
                                                           for c in ("rezagos", "estadistico", "p_value")])
    order = (F.when(F.col("p_value_nivel") < alpha, ORDERS[0]).when(F.col("p_value_nivel").isNull() | F.col("p_value_cambio").isNull(), None)
             .when(F.col("p_value_cambio") < alpha, ORDERS[1]).otherwise(ORDERS[2]))
    return out.withColumn("orden", order)


def order_sql(name: str, source: str, max_lag: int = 12) -> str:
    """CTE ``name``: serie, n, ..., orden."""
    both = f"""{name}_two AS (
  SELECT serie || '|0' AS serie, t, y FROM {source} WHERE y IS NOT NULL
  UNION ALL SELECT serie || '|1', t, d FROM (SELECT serie, t, y - lag(y) OVER (PARTITION BY serie ORDER BY t) AS d FROM {source} WHERE y IS NOT NULL) q WHERE d IS NOT NULL)"""
    return f"""{both},
{adf_sql(name + '_t', name + '_two', 'serie', max_lag)},
{name} AS MATERIALIZED (
  SELECT *, CASE WHEN p_value_nivel < {ALPHA} THEN '{ORDERS[0]}' WHEN p_value_nivel IS NULL OR p_value_cambio IS NULL THEN NULL
                 WHEN p_value_cambio < {ALPHA} THEN '{ORDERS[1]}' ELSE '{ORDERS[2]}' END AS orden
  FROM (SELECT left(serie, length(serie) - 2) AS serie, {', '.join(f"max({c}) FILTER (right(serie, 1) = '{k}') AS {a}" for c, k, a in
        [('n', 0, 'n')] + [(c, k, f'{c}_{x}') for k, x in ((0, 'nivel'), (1, 'cambio')) for c in ('rezagos', 'estadistico', 'p_value')])}
        FROM (SELECT *, {_p_sql('estadistico', 1)} AS p_value FROM {name}_t) q GROUP BY 1) g)"""


def market_series(spark, d) -> DataFrame:
    """(serie, t, y): ln volume and ln price of every segment, monthly export and domestic
    prices, exchange rate and interest rate."""
    v = B.ventas(spark, d).groupBy("Segmento", "CanalVenta", "Anio", "Mes").agg(F.sum("VolumenReal").alias("q"), F.sum("IngresosReales").alias("r"))
    v = materialise(v.withColumn("t", F.col("Anio") * 12 + F.col("Mes")))
    total = lambda df: (F.sum("r").cast("double") / F.sum("q").cast("double"))
    seg = v.groupBy("Segmento", "t").agg(F.log(F.sum("q").cast("double")).alias("vol"), F.log(total(v)).alias("price"))
    seg = seg.select("t", F.explode(F.map_from_arrays(F.array(F.concat(F.lit("volumen "), "Segmento"), F.concat(F.lit("precio "), "Segmento")),
                                                      F.array("vol", "price"))).alias("serie", "y"))
    export = F.col("CanalVenta") == B.EXPORT_SEGMENT
    price = v.groupBy(F.when(export, "precio exportacion").otherwise("precio domestico").alias("serie"), "t").agg(total(v).alias("y"))
    m = B.mercado(spark, d).groupBy((F.year("Fecha") * 12 + F.month("Fecha")).alias("t")).agg(
        F.avg("TipoCambioSpot").alias("fx"), F.avg("TasaDomesticaTNA").alias("rate"))
    m = m.select("t", F.explode(F.map_from_arrays(F.array(F.lit("tipo de cambio"), F.lit("tasa")), F.array("fx", "rate"))).alias("serie", "y"))
    return seg.unionByName(price).unionByName(m).select("serie", "t", "y")


_MARKET_CTES = [B.ventas_sql(), B.MERCADO_SQL, f"""cells AS MATERIALIZED (
  SELECT Segmento, CanalVenta, Anio * 12 + Mes AS t, SUM(VolumenReal) AS q, SUM(IngresosReales) AS r FROM ventas GROUP BY ALL),
market AS MATERIALIZED (
  SELECT 'volumen ' || Segmento AS serie, t, ln(CAST(sum(q) AS DOUBLE)) AS y FROM cells GROUP BY ALL
  UNION ALL SELECT 'precio ' || Segmento, t, ln(CAST(sum(r) AS DOUBLE) / CAST(sum(q) AS DOUBLE)) FROM cells GROUP BY ALL
  UNION ALL SELECT CASE WHEN CanalVenta = '{B.EXPORT_SEGMENT}' THEN 'precio exportacion' ELSE 'precio domestico' END, t, CAST(sum(r) AS DOUBLE) / CAST(sum(q) AS DOUBLE) FROM cells GROUP BY 1, 2
  UNION ALL SELECT 'tipo de cambio', year(Fecha) * 12 + month(Fecha), avg(TipoCambioSpot) FROM mercado GROUP BY 1, 2
  UNION ALL SELECT 'tasa', year(Fecha) * 12 + month(Fecha), avg(TasaDomesticaTNA) FROM mercado GROUP BY 1, 2)"""]

_ROUNDED = ("estadistico_nivel", "p_value_nivel", "estadistico_cambio", "p_value_cambio")


@query("adf_test", with_ctes(*_MARKET_CTES, order_sql("io", "market")) + f"""SELECT serie, CAST(n AS BIGINT) AS n, CAST(rezagos_nivel AS INT) AS rezagos_nivel, CAST(rezagos_cambio AS INT) AS rezagos_cambio,
  {', '.join(f'round({c}, 5) AS {c}' for c in _ROUNDED)}, orden FROM io""")
def q_adf_test(spark, d):
    """Unit-root tests with lags by AIC and the order of integration of all market series."""
    io = integration_order(market_series(spark, d))
    return io.select("serie", "n", "rezagos_nivel", "rezagos_cambio", *[F.round(c, 5).alias(c) for c in _ROUNDED], "orden")


# ---------------------------------------------------------------------------
# Cointegration
# ---------------------------------------------------------------------------

#: Conclusions, to be filled with orders or with p and alpha.
CONCLUSION = {
    "no_valido": ("Test no valido en sentido estricto: y es %s, x es %s. Engle-Granger requiere ambas series I(1). "
                  "Resultado reportado a titulo informativo unicamente."),
    "cointegran": ("Cointegran (p=%.4f < 0.05): existe una relacion de equilibrio de largo plazo entre las series, "
                   "pese a que cada una individualmente tiene raiz unitaria."),
    "no_rechaza": ("No se rechaza ausencia de cointegracion (p=%.4f >= 0.05): no hay evidencia de relacion de largo plazo "
                   "estable entre las series."),
}


def engle_granger(series: DataFrame, pairs: DataFrame, max_lag: int = 12, alpha: float = ALPHA) -> DataFrame:
    """Two-step cointegration tests of stated pairs.

    ``series``: serie, t, y; ``pairs``: par, serie_y, serie_x.  The months that both series of a pair have
    are used.  Result per pair: the order of either, whether both are I(1) (``es_valido``), slope, lags,
    statistic of the residual's unit root, p on the surface of two series, and the conclusion.
    A pair without common months or with a constant series has a null statistic and conclusion.
    """
    s = series.where("y IS NOT NULL").select("serie", "t", F.col("y").cast("double").alias("y"))
    both = (pairs.join(s.withColumnRenamed("serie", "serie_y"), "serie_y")
            .join(s.select(F.col("serie").alias("serie_x"), "t", F.col("y").alias("x")), ["serie_x", "t"])
            .select("par", "t", "y", "x"))
    both = materialise(both)
    sides = both.select(F.concat("par", F.lit("|y")).alias("serie"), "t", "y").unionByName(
        both.select(F.concat("par", F.lit("|x")).alias("serie"), "t", F.col("x").alias("y")))
    orders = integration_order(sides, max_lag, alpha).select(F.expr("left(serie, length(serie) - 2)").alias("par"), F.expr("right(serie, 1)").alias("lado"), "orden")
    orders = orders.groupBy("par").agg(F.max(F.when(F.col("lado") == "y", F.col("orden"))).alias("orden_y"),
                                       F.max(F.when(F.col("lado") == "x", F.col("orden"))).alias("orden_x"))
    line = both.groupBy("par").agg(F.regr_slope("y", "x").alias("pendiente"), F.avg("y").alias("_y"), F.avg("x").alias("_x"))
    residual = both.join(line, "par").select("par", "t", (F.col("y") - F.col("_y") - F.col("pendiente") * (F.col("x") - F.col("_x"))).alias("y"))
    test = adf(residual, ["par"], max_lag=max_lag, constant=False).withColumn("p_value", unit_root_p(F.col("estadistico"), 2))
    out = (pairs.join(orders, "par", "left").join(line.select("par", "pendiente"), "par", "left").join(test, "par", "left")
           .withColumn("es_valido", F.coalesce((F.col("orden_y") == ORDERS[1]) & (F.col("orden_x") == ORDERS[1]), F.lit(False))))
    return out.withColumn("conclusion", conclusion(alpha))


def conclusion(alpha: float = ALPHA) -> Column:
    p = F.col("p_value")
    return (F.when(p.isNull() | F.col("orden_y").isNull() | F.col("orden_x").isNull(), None)
            .when(~F.col("es_valido"), F.format_string(CONCLUSION["no_valido"], "orden_y", "orden_x"))
            .when(p < alpha, F.format_string(CONCLUSION["cointegran"], p)).otherwise(F.format_string(CONCLUSION["no_rechaza"], p)))


SEGMENTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
#: Pairs of the query: the prices against the exchange rate and the interest rate, and the volume of
#: each segment against its price.
PAIRS = [("exportacion-cambio", "precio exportacion", "tipo de cambio"), ("domestico-tasa", "precio domestico", "tasa"),
         *[(f"volumen-precio {s}", f"volumen {s}", f"precio {s}") for s in SEGMENTS]]

_EG_CTES = [*_MARKET_CTES, f"""pairs(par, serie_y, serie_x) AS (VALUES {', '.join(str(p) for p in PAIRS)}),
joint AS MATERIALIZED (
  SELECT par, a.t, a.y, b.y AS x FROM pairs JOIN market a ON a.serie = serie_y JOIN market b ON b.serie = serie_x AND b.t = a.t),
sides AS (SELECT par || '|y' AS serie, t, y FROM joint UNION ALL SELECT par || '|x', t, x FROM joint)""",
            order_sql("io", "sides"), """res AS MATERIALIZED (
  SELECT par AS serie, t, y - avg(y) OVER s - (x - avg(x) OVER s) * covar_pop(y, x) OVER s / var_pop(x) OVER s AS y, covar_pop(y, x) OVER s / var_pop(x) OVER s AS b
  FROM joint WINDOW s AS (PARTITION BY par))""", adf_sql("eg", "res", "serie", constant=False), f"""tested AS (
  SELECT p.par, serie_y, serie_x, (SELECT orden FROM io WHERE serie = p.par || '|y') AS orden_y, (SELECT orden FROM io WHERE serie = p.par || '|x') AS orden_x,
         (SELECT max(b) FROM res WHERE serie = p.par) AS pendiente, e.n, e.rezagos, e.estadistico, {_p_sql('e.estadistico', 2)} AS p_value
  FROM pairs p LEFT JOIN eg e ON e.serie = p.par)"""]

@query("engle_granger", with_ctes(*_EG_CTES) + f"""SELECT par, serie_y, serie_x, orden_y, orden_x, es_valido, round(pendiente, 5) AS pendiente, CAST(n AS BIGINT) AS n,
  CAST(rezagos AS INT) AS rezagos, round(estadistico, 5) AS estadistico, round(p_value, 5) AS p_value,
  CASE WHEN p_value IS NULL OR orden_y IS NULL OR orden_x IS NULL THEN NULL WHEN NOT es_valido THEN printf('{CONCLUSION["no_valido"]}', orden_y, orden_x)
       WHEN p_value < {ALPHA} THEN printf('{CONCLUSION["cointegran"]}', p_value) ELSE printf('{CONCLUSION["no_rechaza"]}', p_value) END AS conclusion
FROM (SELECT *, coalesce(orden_y = '{ORDERS[1]}' AND orden_x = '{ORDERS[1]}', false) AS es_valido FROM tested) t""")
def q_engle_granger(spark, d):
    """Cointegration of the stated pairs of market series."""
    pairs = spark.createDataFrame(PAIRS, "par string, serie_y string, serie_x string")
    eg = engle_granger(market_series(spark, d), pairs)
    return eg.select("par", "serie_y", "serie_x", "orden_y", "orden_x", "es_valido", F.round("pendiente", 5).alias("pendiente"), "n", "rezagos",
                     F.round("estadistico", 5).alias("estadistico"), F.round("p_value", 5).alias("p_value"), "conclusion")


# ---------------------------------------------------------------------------
# Forecast candidates: seasonal autoregression and regression on lagged features
# ---------------------------------------------------------------------------

# Names of the candidates, quantile of the band.
NAIVE, AUTOREGRESSIVE, REGRESSION = MODELS = ("Benchmark_Estacional", "Autorregresivo_Estacional", "Regresion_Rezagos")
BAND = 1.96
PERIOD = 12
#: Lags of the long autoregression, then of the second stage: of the twice differenced series and of its residuals.
LONG_LAGS, AR_LAGS, MA_LAGS = (1, 2, 3, 4, 12), (1, 12, 13), (1,)
FEATURES = ("lag_1", "lag_2", "lag_3", "lag_12", "rm_12", "mes_sin", "mes_cos", "tendencia")


def _lag(column: str, k: int) -> Column:
    """Value ``k`` months earlier, by month number: a missing month is no lag."""
    return F.max(column).over(Window.partitionBy("serie").orderBy("t").rangeBetween(-k, -k))


def differenced(train: DataFrame) -> DataFrame:
    """serie, t, y, w: the series freed of trend and season by differences of one month and of twelve."""
    x = train.select("serie", "t", "y").withColumns({f"_{k}": _lag("y", k) for k in (1, PERIOD, PERIOD + 1)})
    return x.select("serie", "t", "y", (F.col("y") - F.col("_1") - F.col(f"_{PERIOD}") + F.col(f"_{PERIOD + 1}")).alias("w"))


def _fitted(gram: list, size: int, obs: int) -> dict:
    """Coefficients and variance of the regression of the first column on all others, null where it has none."""
    one = fit(matrix(gram, size), 0, list(range(1, size))) if obs > size else None
    return {"b": None if one is None else one[0].tolist(), "variance": None if one is None else one[1] / (obs - size + 1)}


def long_autoregression(diff: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First stage: (serie, obs, b, variance) and the rows of ``diff`` with the residual ``e``."""
    lags = [f"w{k}" for k in LONG_LAGS]
    x = materialise(diff.withColumns({f"w{k}": _lag("w", k) for k in LONG_LAGS}))
    rows = x.where(" AND ".join(f"{c} IS NOT NULL" for c in ["w", *lags]))
    size = len(lags) + 1
    b = solved(products(rows, ["serie"], [F.col(c) for c in ["w", *lags]]), ["serie", "obs"],
               lambda r: _fitted(r["gram"], size, r["obs"]), "b array<double>, variance double")
    b = materialise(b)
    guess = sum((F.col("b")[k] * F.col(c) for k, c in enumerate(lags)), F.lit(0.0))
    residuals = x.join(b.select("serie", "b"), "serie", "left").select("serie", "t", "y", "w", (F.col("w") - guess).alias("e"))
    return b, residuals


def _recursion(state: dict, horizon: int) -> tuple[list[float], list[float]]:
    """Forecasts and standard errors of one series from its last values (latest first)."""
    y, w, e = ([*reversed(state[k])] for k in ("ys", "ws", "es"))
    ar, ma = state["b"][:len(AR_LAGS)], state["b"][len(AR_LAGS):]
    for _ in range(horizon):
        w.append(sum(c * w[-k] for c, k in zip(ar, AR_LAGS)) + sum(c * e[-k] for c, k in zip(ma, MA_LAGS)))
        e.append(0.0)
        y.append(w[-1] + y[-1] + y[-PERIOD] - y[-PERIOD - 1])
    # effect of one shock on the following months, differences undone
    u, v = [0.0] * (PERIOD + 1), [0.0] * (PERIOD + 1)
    for h in range(horizon):
        shock = sum(c * u[-k] for c, k in zip(ar, AR_LAGS)) + (1.0 if h == 0 else 0.0) + sum(c for c, k in zip(ma, MA_LAGS) if k == h)
        u.append(shock)
        v.append(shock + v[-1] + v[-PERIOD] - v[-PERIOD - 1])
    total, error = 0.0, []
    for effect in v[PERIOD + 1:]:
        total += effect * effect
        error.append(math.sqrt(state["variance"] * total))
    return y[-horizon:], error


def autoregressive_forecast(train: DataFrame, horizon: int = 12) -> DataFrame:
    """Seasonal ARMA by two regressions (Hannan and Rissanen): serie, t, yhat, error.

    A long autoregression of the differenced series gives residuals; the second regression has
    lags of the series and of those residuals.  The next ``horizon`` months follow by recursion, and
    their standard error from the effects of a shock, so the band grows.  A series that is too
    short, has gaps in its last months or dependent lags gets no rows.
    """
    _, x = long_autoregression(differenced(train))
    lags = {**{f"w{k}": _lag("w", k) for k in AR_LAGS}, **{f"e{k}": _lag("e", k) for k in MA_LAGS}}
    x = materialise(x.withColumns(lags))
    columns = ["w", *lags]
    rows = x.where(" AND ".join(f"{c} IS NOT NULL" for c in columns))
    size = len(columns)
    b = solved(products(rows, ["serie"], [F.col(c) for c in columns]), ["serie"], lambda r: _fitted(r["gram"], size, r["obs"]), "b array<double>, variance double")
    last = x.withColumn("_k", F.max("t").over(Window.partitionBy("serie")) - F.col("t")).where(F.col("_k") <= PERIOD)
    keep = lambda c, n: F.array(*[F.max(F.when(F.col("_k") == k, F.col(c))) for k in range(n)])
    state = last.groupBy("serie").agg(F.max("t").alias("t0"), keep("y", PERIOD + 1).alias("ys"), keep("w", PERIOD + 1).alias("ws"), keep("e", max(MA_LAGS)).alias("es"))
    whole = F.forall(F.concat("ys", "ws", "es"), lambda v: v.isNotNull())
    state = state.where(whole).join(b.where("b IS NOT NULL"), "serie")

    def forecast(row: dict) -> dict:
        y, error = _recursion(row, horizon)
        return {"yhat": y, "error": error}

    out = solved(state, ["serie", "t0"], forecast, "yhat array<double>, error array<double>")
    return (out.select("serie", "t0", F.posexplode(F.arrays_zip("yhat", "error")).alias("_h", "_f"))
            .select("serie", (F.col("t0") + F.col("_h") + 1).cast("int").alias("t"), F.col("_f.yhat").alias("yhat"), F.col("_f.error").alias("error")))


def feature_forecast(series: DataFrame, horizon: int = 12) -> DataFrame:
    """Regression of a month on its lags, the mean of the year before, season and trend, fitted on the months before the
    last ``horizon`` and applied to those with the lags as observed: serie, t, yhat, error."""
    w = Window.partitionBy("serie").orderBy("t")
    year = Window.partitionBy("serie").orderBy("t").rangeBetween(-PERIOD, -1)
    month = 2 * math.pi * F.col("Mes") / 12
    x = series.withColumns({**{f"lag_{k}": _lag("y", k) for k in (1, 2, 3, 12)}, "rm_12": F.when(F.count("y").over(year) == PERIOD, F.avg("y").over(year)),
                            "mes_sin": F.sin(month), "mes_cos": F.cos(month), "tendencia": F.row_number().over(w).cast("double"),
                            "_k": F.row_number().over(Window.partitionBy("serie").orderBy(F.col("t").desc()))})
    x = materialise(x.na.drop(subset=list(FEATURES)))
    columns = [F.col("y"), *(F.col(c) for c in FEATURES), F.lit(1.0)]
    size = len(columns)
    b = solved(products(x.where(F.col("_k") > horizon), ["serie"], columns), ["serie", "obs"], lambda r: _fitted(r["gram"], size, r["obs"]), "b array<double>, variance double")
    guess = sum((F.col("b")[k] * c for k, c in enumerate(columns[1:])), F.lit(0.0))
    # the band is that of the training residuals, as a whole
    error = F.sqrt(F.col("variance") * (F.col("obs") - size + 1) / F.col("obs"))
    return x.where(F.col("_k") <= horizon).join(b.where("b IS NOT NULL"), "serie").select("serie", "t", guess.alias("yhat"), error.alias("error"))


def forecast_candidates(series: DataFrame, horizon: int = 12) -> DataFrame:
    """Forecasts of the last ``horizon`` months by three candidates: serie, t, y, Modelo, yhat, error (null: no band)."""
    x = materialise(series.withColumn("_k", F.row_number().over(Window.partitionBy("serie").orderBy(F.col("t").desc()))).withColumn("_12", _lag("y", PERIOD)))
    test = x.where(F.col("_k") <= horizon).select("serie", "t", "y", "_12")
    ar = autoregressive_forecast(x.where(F.col("_k") > horizon), horizon).withColumn("Modelo", F.lit(AUTOREGRESSIVE))
    rg = feature_forecast(x.drop("_k", "_12"), horizon).withColumn("Modelo", F.lit(REGRESSION))
    naive = test.where("_12 IS NOT NULL").select("serie", "t", "y", F.lit(NAIVE).alias("Modelo"), F.col("_12").alias("yhat"), F.lit(None).cast("double").alias("error"))
    return test.drop("_12").join(ar.unionByName(rg), ["serie", "t"]).select(naive.columns).unionByName(naive)


def candidate_metrics(forecasts: DataFrame) -> DataFrame:
    """RMSE, MAE, MAPE, R2, reduction of the RMSE against the seasonal benchmark, share inside the 95 % band, rank by RMSE (ties: by name)."""
    e = F.col("yhat") - F.col("y")
    m = forecasts.groupBy("serie", "Modelo").agg(
        F.sqrt(F.avg(e ** 2)).alias("RMSE"), F.avg(F.abs(e)).alias("MAE"), (F.avg(F.abs(e / F.when(F.col("y") != 0, F.col("y")))) * 100).alias("MAPE_Pct"),
        (1 - F.sum(e ** 2) / (F.count("y") * F.var_pop("y"))).alias("R2_Score"), F.avg((F.abs(e) <= BAND * F.col("error")).cast("double")).alias("EnBanda"))
    whole = Window.partitionBy("serie")
    base = F.max(F.when(F.col("Modelo") == NAIVE, F.col("RMSE"))).over(whole)
    return m.withColumns({"Reduccion_RMSE_Pct": (base - F.col("RMSE")) / base * 100, "Ranking_Precision": F.row_number().over(whole.orderBy("RMSE", "Modelo"))})


_CAND_CTES = [B.ventas_sql(channel=False), series_sql("Segmento"), """ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY serie ORDER BY t DESC) AS k, max(y) OVER (PARTITION BY serie ORDER BY t RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS y12 FROM ms),
dif AS MATERIALIZED (
  SELECT a.serie, a.t, a.y, a.y - b.y - c.y + e.y AS w FROM ranked a LEFT JOIN ranked b ON b.serie = a.serie AND b.t = a.t - 1
  LEFT JOIN ranked c ON c.serie = a.serie AND c.t = a.t - 12 LEFT JOIN ranked e ON e.serie = a.serie AND e.t = a.t - 13 WHERE a.k > 12),
st1 AS MATERIALIZED (
  SELECT * FROM (SELECT serie, t, y, w, """ + ", ".join(f"max(w) OVER (PARTITION BY serie ORDER BY t RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS w{k}" for k in LONG_LAGS) + """ FROM dif) q),
st1_rows AS (SELECT * FROM st1 WHERE w IS NOT NULL AND """ + " AND ".join(f"w{k} IS NOT NULL" for k in LONG_LAGS) + ")",
              ols_sql("ar1", "st1_rows", "serie", "w", [f"w{k}" for k in LONG_LAGS])]

_HR_CTES = ["""resid AS MATERIALIZED (
  SELECT s.serie, t, y, w, w - (""" + " + ".join(f"b_w{k} * w{k}" for k in LONG_LAGS) + """) AS e FROM st1 s LEFT JOIN ar1 USING (serie)),
st2 AS MATERIALIZED (
  SELECT *, """ + ", ".join([f"max(w) OVER (PARTITION BY serie ORDER BY t RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS w{k}" for k in AR_LAGS]
                            + [f"max(e) OVER (PARTITION BY serie ORDER BY t RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS e{k}" for k in MA_LAGS]) + """ FROM resid),
st2_rows AS (SELECT * FROM st2 WHERE w IS NOT NULL AND """ + " AND ".join([f"w{k} IS NOT NULL" for k in AR_LAGS] + [f"e{k} IS NOT NULL" for k in MA_LAGS]) + ")",
            ols_sql("ar2", "st2_rows", "serie", "w", [f"w{k}" for k in AR_LAGS] + [f"e{k}" for k in MA_LAGS]),
            """fin AS (
  SELECT serie, max(t) AS t0, list(y ORDER BY t) AS ys, list(w ORDER BY t) AS ws, arg_max(e, t) AS e0 FROM st2 GROUP BY serie),
walk AS (
  SELECT serie, t0, 0 AS h, ys, ws, e0, [0.0::DOUBLE for z in range(13)] AS u, [0.0::DOUBLE for z in range(13)] AS v, b_w1, b_w12, b_w13, b_e1, sse / (obs - 4) AS variance
  FROM fin JOIN ar2 USING (serie)
  UNION ALL
  SELECT serie, t0, h + 1, list_append(ys, wn + ys[-1] + ys[-12] - ys[-13]), list_append(ws, wn), 0.0, list_append(u, un), list_append(v, un + v[-1] + v[-12] - v[-13]),
         b_w1, b_w12, b_w13, b_e1, variance
  FROM (SELECT *, b_w1 * ws[-1] + b_w12 * ws[-12] + b_w13 * ws[-13] + b_e1 * e0 AS wn,
               b_w1 * u[-1] + b_w12 * u[-12] + b_w13 * u[-13] + CASE h WHEN 0 THEN 1.0 WHEN 1 THEN b_e1 ELSE 0.0 END AS un FROM walk WHERE h < 12) q),
ar_f AS (SELECT serie, t0 + h AS t, ys[-1] AS yhat, sqrt(variance * list_sum([z * z for z in v])) AS error FROM walk WHERE h > 0)""",
            """feat AS MATERIALIZED (
  SELECT * FROM (
    SELECT serie, t, y, row_number() OVER (PARTITION BY serie ORDER BY t DESC) AS k, row_number() OVER w::DOUBLE AS tendencia, sin(2 * pi() * Mes / 12) AS mes_sin, cos(2 * pi() * Mes / 12) AS mes_cos,
           """ + ", ".join(f"max(y) OVER (w RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS lag_{k}" for k in (1, 2, 3, 12)) + """,
           CASE WHEN count(y) OVER (w RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) = 12 THEN avg(y) OVER (w RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) END AS rm_12
    FROM ms WINDOW w AS (PARTITION BY serie ORDER BY t)) q WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES) + """),
feat_train AS (SELECT *, 1.0::DOUBLE AS one FROM feat WHERE k > 12)""", ols_sql("rg", "feat_train", "serie", "y", [*FEATURES, "one"]),
            f"""cand AS (
  SELECT r.serie, r.t, r.y, '{AUTOREGRESSIVE}' AS Modelo, yhat, error FROM ranked r JOIN ar_f USING (serie, t)
  UNION ALL SELECT f.serie, f.t, f.y, '{REGRESSION}', """ + " + ".join(f"b_{c} * {c}" for c in FEATURES) + f""" + b_one, sqrt(sse / obs) FROM feat f JOIN rg USING (serie) WHERE k <= 12
  UNION ALL SELECT serie, t, y, '{NAIVE}', y12, NULL FROM ranked WHERE k <= 12 AND y12 IS NOT NULL),
met AS (
  SELECT serie, Modelo, sqrt(avg((yhat - y) ^ 2)) AS RMSE, avg(abs(yhat - y)) AS MAE, avg(abs((yhat - y) / y)) * 100 AS MAPE_Pct, 1 - sum((yhat - y) ^ 2) / (count(y) * var_pop(y)) AS R2_Score,
         avg(CASE WHEN error IS NULL THEN NULL WHEN abs(yhat - y) <= {BAND} * error THEN 1.0 ELSE 0.0 END) AS EnBanda FROM cand GROUP BY ALL)"""]


@query("long_autoregression", with_ctes(*_CAND_CTES) + "SELECT serie, obs AS Observaciones, " + ", ".join(f"round(b_w{k}, 5) AS Rezago_{k}" for k in LONG_LAGS)
       + f", round(sqrt(sse / (obs - {len(LONG_LAGS)})), 2) AS Desvio FROM ar1")
def q_long_autoregression(spark, d):
    """First stage of the seasonal autoregression per segment: coefficients and standard deviation."""
    s = monthly_series(B.ventas(spark, d, channel=False), "Segmento")
    w = Window.partitionBy("serie").orderBy(F.col("t").desc())
    b, _ = long_autoregression(differenced(s.withColumn("_k", F.row_number().over(w)).where("_k > 12")))
    return b.select("serie", F.col("obs").alias("Observaciones"), *[F.round(F.col("b")[i], 5).alias(f"Rezago_{k}") for i, k in enumerate(LONG_LAGS)],
                    F.round(F.sqrt("variance"), 2).alias("Desvio"))


@query("forecast_candidates", with_ctes(*_CAND_CTES, *_HR_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT serie, Modelo, round(RMSE, 2) AS RMSE, round(MAE, 2) AS MAE, round(MAPE_Pct, 4) AS MAPE_Pct, round(R2_Score, 4) AS R2_Score,
  round(EnBanda, 6) AS EnBanda, round((base - RMSE) / base * 100, 4) AS Reduccion_RMSE_Pct, CAST(row_number() OVER (PARTITION BY serie ORDER BY RMSE, Modelo) AS INT) AS Ranking_Precision
FROM (SELECT *, max(RMSE) FILTER (Modelo = '{NAIVE}') OVER (PARTITION BY serie) AS base FROM met) q""")
def q_forecast_candidates(spark, d):
    """Backtest of the seasonal benchmark, the seasonal autoregression and the regression per segment."""
    m = candidate_metrics(forecast_candidates(monthly_series(B.ventas(spark, d, channel=False), "Segmento")))
    return m.select("serie", "Modelo", *[F.round(c, n).alias(c) for c, n in (("RMSE", 2), ("MAE", 2), ("MAPE_Pct", 4), ("R2_Score", 4), ("EnBanda", 6), ("Reduccion_RMSE_Pct", 4))],
                    "Ranking_Precision")


@query("forecast_bands", with_ctes(*_CAND_CTES, *_HR_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT serie, t, Modelo, round(y, 2) AS y, round(yhat, 2) AS yhat,
  round(yhat - {BAND} * error, 2) AS IC_Inferior_95, round(yhat + {BAND} * error, 2) AS IC_Superior_95 FROM cand""")
def q_forecast_bands(spark, d):
    """The forecast months of every candidate with its band."""
    c = forecast_candidates(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))
    return c.select("serie", "t", "Modelo", F.round("y", 2).alias("y"), F.round("yhat", 2).alias("yhat"), F.round(F.col("yhat") - BAND * F.col("error"), 2).alias("IC_Inferior_95"),
                    F.round(F.col("yhat") + BAND * F.col("error"), 2).alias("IC_Superior_95"))


# ---------------------------------------------------------------------------
# Grid of lag orders
# ---------------------------------------------------------------------------

#: Candidates of the grid: sets of lags, each with a constant.
GRID = ((1,), (12,), (1, 2), (1, 12), (1, 12, 13), (1, 2, 3, 12))
#: Why a candidate has no fit.
SINGULAR_TEXT, SHORT_TEXT, EXACT_TEXT = "rezagos linealmente dependientes", "pocas observaciones", "ajuste exacto"


def order_grid(series: DataFrame, grid: tuple[tuple[int, ...], ...] = GRID) -> DataFrame:
    """Every candidate of the grid per series: serie, Rezagos, Parametros, Observaciones, AIC, Error, Elegido.

    One aggregate of products of all lags per series; each candidate is solved from its rows and columns,
    on the months that all lags have.  Candidates without a fit keep their row, with the reason."""
    lags = sorted({k for c in grid for k in c})
    x = series.select("serie", "t", "y").withColumns({f"l{k}": _lag("y", k) for k in lags}).na.drop(subset=["y", *(f"l{k}" for k in lags)])
    columns = [F.col("y"), *(F.col(f"l{k}") for k in lags), F.lit(1.0)]
    size = len(columns)
    at = {k: 1 + i for i, k in enumerate(lags)}

    def solve(row: dict) -> dict:
        gram, n, out = matrix(row["gram"], size), row["obs"], []
        for c in grid:
            cols = [*(at[k] for k in c), size - 1]
            one, aic, error = None, None, SHORT_TEXT
            if n > len(cols):
                one = fit(gram, 0, cols)
                error = SINGULAR_TEXT
            if one is not None:
                error = None if one[1] > 1e-12 * gram[0, 0] else EXACT_TEXT
                aic = n * math.log(one[1] / n) + 2 * len(cols) if error is None else None
            out.append({"Rezagos": "+".join(map(str, c)), "Parametros": len(cols), "AIC": aic, "Error": error})
        return {"c": out}

    rows = solved(products(x, ["serie"], columns), ["serie", "obs"], solve, "c array<struct<Rezagos:string,Parametros:int,AIC:double,Error:string>>")
    out = rows.select("serie", F.col("obs").alias("Observaciones"), F.inline("c"))
    first = F.row_number().over(Window.partitionBy("serie").orderBy(F.col("AIC").asc_nulls_last(), "Parametros", "Rezagos")) == 1
    return out.withColumn("Elegido", first & F.col("AIC").isNotNull())


_GRID_LAGS = sorted({k for c in GRID for k in c})


@query("order_grid", with_ctes(B.ventas_sql(channel=False), series_sql("Segmento"), "grid AS MATERIALIZED (SELECT * FROM (SELECT serie, t, y, 1.0::DOUBLE AS one, " + ", ".join(
    f"max(y) OVER (PARTITION BY serie ORDER BY t RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS l{k}" for k in _GRID_LAGS) + " FROM ms) q WHERE " + " AND ".join(f"l{k} IS NOT NULL" for k in _GRID_LAGS) + ")",
    *[ols_sql(f"g{i}", "grid", "serie", "y", ["one", *(f"l{k}" for k in c)]) for i, c in enumerate(GRID)]) + "SELECT *, row_number() OVER (PARTITION BY serie ORDER BY AIC, Parametros, Rezagos) = 1 AS Elegido FROM ("
       + " UNION ALL ".join(f"SELECT serie, obs AS Observaciones, '{'+'.join(map(str, c))}' AS Rezagos, {len(c) + 1} AS Parametros, round(obs * ln(sse / obs) + {2 * (len(c) + 1)}, 4) AS AIC, CAST(NULL AS VARCHAR) AS Error FROM g{i}"
                            for i, c in enumerate(GRID)) + ") q")
def q_order_grid(spark, d):
    """Lag orders with several regressors per segment, the best by AIC marked."""
    g = order_grid(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))
    return g.select("serie", "Observaciones", "Rezagos", "Parametros", F.round("AIC", 4).alias("AIC"), "Error", "Elegido")


# ---------------------------------------------------------------------------
# Seasonal decomposition by local regression
# ---------------------------------------------------------------------------

_STL_CTES = [B.ventas_sql(channel=False), series_sql("Segmento"), decompose_sql("stl", "ms")]


@query("seasonal_decomposition", with_ctes(*_STL_CTES) + "SELECT serie, t, round(tendencia, 3) AS Tendencia, round(estacional, 3) AS Estacional, round(resto, 3) AS Resto FROM stl")
def q_seasonal_decomposition(spark, d):
    """Trend, season and rest of the monthly sales per segment."""
    x = decompose(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))
    return x.select("serie", "t", F.round("tendencia", 3).alias("Tendencia"), F.round("estacional", 3).alias("Estacional"), F.round("resto", 3).alias("Resto"))


@query("seasonal_index_loess", with_ctes(*_STL_CTES) + """SELECT serie, Mes, round(1 + avg(estacional) / any_value(nivel), 8) AS indice_estacional
FROM (SELECT *, avg(tendencia) OVER (PARTITION BY serie) AS nivel FROM stl) s GROUP BY serie, Mes""")
def q_seasonal_index_loess(spark, d):
    """Seasonal index from the decomposition: one plus the mean season of a calendar month over the mean trend."""
    x = decompose(monthly_series(B.ventas(spark, d, channel=False), "Segmento"))
    level = x.groupBy("serie").agg(F.avg("tendencia").alias("nivel"))  # one row per series
    return (x.groupBy("serie", "Mes").agg(F.avg("estacional").alias("s")).join(level, "serie")
            .select("serie", "Mes", F.round(1 + F.col("s") / F.col("nivel"), 8).alias("indice_estacional")))
