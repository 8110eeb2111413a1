"""Unit roots, cointegration, autoregressive forecasts and lag orders against plain numpy and planted truth."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.regression import adf, unit_root_p
from ledgerlake.plans import econometrics as E

SCHEMA = "serie string, t int, y double"


def frame(spark, series: dict):
    return spark.createDataFrame([(k, t, None if v is None else float(v)) for k, ys in series.items() for t, v in enumerate(ys)], SCHEMA)


def plain_adf(y, max_lag=12, constant=True):
    """Row by row with numpy's least squares."""
    y = np.asarray(y, float)
    d, n = np.diff(y), len(y)
    most = min(max_lag, math.ceil(12 * (n / 100) ** 0.25), n // 2 - (2 if constant else 1))

    def regress(p, start):
        rows = range(start, len(d))
        X = np.array([[y[t], *(d[t - k] for k in range(1, p + 1)), *([1.0] if constant else [])] for t in rows])
        target = d[start:]
        b, *_ = np.linalg.lstsq(X, target, rcond=None)
        return X, b, float(((target - X @ b) ** 2).sum())

    best = []
    for p in range(most + 1):
        X, _, sse = regress(p, most)
        if len(X) > X.shape[1]:
            best.append((len(X) * math.log(sse / len(X)) + 2 * X.shape[1], p))
    p = min(best)[1]
    X, b, sse = regress(p, p)
    return p, b[0] / math.sqrt(sse / (len(X) - X.shape[1]) * np.linalg.inv(X.T @ X)[0, 0])


def walks(seed, n):
    rng = np.random.default_rng(seed)
    return np.cumsum(rng.normal(0, 1, n)), rng


@pytest.mark.parametrize("constant", [True, False])
def test_adf_plain(spark, constant):
    series = {}
    for k, n in enumerate((20, 35, 80, 120, 200)):
        w, rng = walks(k, n)
        noise = rng.normal(0, 1, n)
        series[f"walk{n}"], series[f"noise{n}"] = w + 1000, noise
        series[f"ar{n}"] = np.array([noise[t] + 0.5 * noise[t - 1] - 0.4 * noise[t - 2] for t in range(n)])
    got = {r.serie: r for r in adf(frame(spark, series), ["serie"], constant=constant).collect()}
    for name, y in series.items():
        p, stat = plain_adf(y, constant=constant)
        assert got[name].rezagos == p and got[name].estadistico == pytest.approx(stat, rel=1e-6) and got[name].n == len(y)


def test_p_values(spark):
    """Two published results, the usual 5 % values, and the limits of the surface."""
    df = spark.createDataFrame([(-2.860272318248643,), (-4.513997561211294,), (-3.34,), (-2.86,), (0.0,), (-30.0,), (9.0,), (None,)], "s double")
    two = [r[0] for r in df.select(unit_root_p(F.col("s"), 2)).collect()]
    one = [r[0] for r in df.select(unit_root_p(F.col("s"), 1)).collect()]
    assert two[0] == pytest.approx(0.14725862, abs=1e-6) and two[1] == pytest.approx(0.00116138, abs=1e-6)
    assert two[2] == pytest.approx(0.05, abs=1e-3) and one[3] == pytest.approx(0.05, abs=1e-3) and one[4] == pytest.approx(0.9585, abs=1e-3)
    assert one[5:] == two[5:] == [0.0, 1.0, None]


def test_orders(spark):
    w, rng = walks(11, 150)
    got = {r.serie: r for r in E.integration_order(frame(spark, {
        "noise": rng.normal(0, 1, 150), "walk": w, "twice": np.cumsum(np.cumsum(rng.normal(0, 1, 150))), "constant": [5.0] * 40, "short": [1.0, 2.0, 1.5],
        "holes": [None if k % 7 == 3 else v for k, v in enumerate(w)], "nulls": [None] * 9})).collect()}
    assert (got["noise"].orden, got["walk"].orden, got["twice"].orden) == ("I(0)", "I(1)", "I(2)+")
    assert got["constant"].orden is None and got["short"].orden is None and "nulls" not in got
    assert got["holes"].n == sum(k % 7 != 3 for k in range(150))


def test_planted_cointegration(spark):
    x, rng = walks(1, 120)
    series = {"x": x, "y": 2 * x + rng.normal(0, 0.5, 120), "still": rng.normal(0, 1, 120), "flat": [3.0] * 120}
    series |= {f"z{k}": np.cumsum(rng.normal(0, 1, 120)) for k in range(12)}
    pairs = spark.createDataFrame([("both", "y", "x"), ("order", "still", "x"), ("flat", "x", "flat"), ("absent", "x", "none"),
                                   *[(f"apart{k}", f"z{k}", "x") for k in range(12)]], "par string, serie_y string, serie_x string")
    got = {r.par: r for r in E.engle_granger(frame(spark, series), pairs).collect()}
    assert got["both"].es_valido and got["both"].p_value < 0.05 and got["both"].conclusion.startswith("Cointegran") and got["both"].pendiente == pytest.approx(2, abs=0.05)
    # independent walks: one in twenty is rejected by chance
    assert sum(got[f"apart{k}"].p_value < 0.05 for k in range(12)) <= 3
    assert all(got[f"apart{k}"].conclusion.startswith("No se rechaza") for k in range(12) if got[f"apart{k}"].es_valido and got[f"apart{k}"].p_value >= 0.05)
    assert not got["order"].es_valido and "y es I(0), x es I(1)" in got["order"].conclusion
    assert got["flat"].conclusion is None and got["absent"].estadistico is None and got["absent"].conclusion is None
    # the statistic is that of the residual without a constant
    b, a = np.polyfit(x, series["y"], 1)
    assert got["both"].estadistico == pytest.approx(plain_adf(series["y"] - a - b * x, constant=False)[1], rel=1e-5)


def seasonal(seed, n=120, phi=0.8):
    """Trend, season and an autoregressive swing that a value of last year does not know."""
    rng = np.random.default_rng(seed)
    u = np.zeros(n)
    for t in range(1, n):
        u[t] = phi * u[t - 1] + rng.normal(0, 1)
    return [500 + 3 * t + 30 * math.sin(2 * math.pi * t / 12) + 4 * u[t] for t in range(n)]


def monthly(spark, series: dict, skip=()):
    rows = [(k, t // 12, t % 12 + 1, t, float(v)) for k, ys in series.items() for t, v in enumerate(ys) if (k, t) not in skip]
    return spark.createDataFrame(rows, "serie string, Anio int, Mes int, t int, y double")


def test_autoregression_beats_naive(spark):
    series = {f"s{k}": seasonal(k) for k in range(6)} | {"short": seasonal(9, 30)}
    got = E.forecast_candidates(monthly(spark, series))
    rmse = {(r.serie, r.Modelo): r for r in E.candidate_metrics(got).collect()}
    for k in range(6):
        own, base = rmse[f"s{k}", E.AUTOREGRESSIVE], rmse[f"s{k}", E.NAIVE]
        assert own.RMSE < base.RMSE and own.Reduccion_RMSE_Pct > 0 and own.EnBanda >= 0.5 and base.EnBanda is None
        assert {rmse[f"s{k}", m].Ranking_Precision for m in E.MODELS} == {1, 2, 3}
    # too short for the second stage: no forecast, the benchmark stays
    assert ("short", E.AUTOREGRESSIVE) not in rmse and ("short", E.NAIVE) in rmse
    band = {}
    for r in got.where(f"Modelo = '{E.AUTOREGRESSIVE}'").collect():
        band.setdefault(r.serie, {})[r.t] = r.error
    assert all([e for _, e in sorted(b.items())] == sorted(b.values()) and len(set(b.values())) == 12 for b in band.values())


def test_gap_in_last_months(spark):
    series = {"whole": seasonal(1), "gap": seasonal(2)}
    got = E.autoregressive_forecast(monthly(spark, series, {("gap", 110)}).select("serie", "t", "y")).groupBy("serie").count().collect()
    assert [tuple(r) for r in got] == [("whole", 12)]


def test_recursion_is_plain(spark):
    """Forecasts and standard errors against a simulation of the recursion's own equation."""
    ys = seasonal(5)
    rows = E.autoregressive_forecast(monthly(spark, {"s": ys}).select("serie", "t", "y"), 4).orderBy("t").collect()
    w = [ys[t] - ys[t - 1] - ys[t - 12] + ys[t - 13] for t in range(13, 120)]
    n = len(w)
    long_rows = range(12, n)
    X = np.array([[w[t - k] for k in E.LONG_LAGS] for t in long_rows])
    b, *_ = np.linalg.lstsq(X, np.array(w[12:]), rcond=None)
    e = {t: w[t] - X[t - 12] @ b for t in long_rows}
    second = range(13, n)
    X2 = np.array([[w[t - 1], w[t - 12], w[t - 13], e[t - 1]] for t in second])
    c, *_ = np.linalg.lstsq(X2, np.array(w[13:]), rcond=None)
    sse = float(((np.array(w[13:]) - X2 @ c) ** 2).sum())
    w, y = list(w), list(ys)
    for h in range(4):
        w.append(c[0] * w[-1] + c[1] * w[-12] + c[2] * w[-13] + (c[3] * e[n - 1] if h == 0 else 0))
        y.append(w[-1] + y[-1] + y[-12] - y[-13])
    assert [r.yhat for r in rows] == pytest.approx(y[-4:], rel=1e-6)
    sigma = math.sqrt(sse / (len(second) - 4))
    assert rows[0].error == pytest.approx(sigma, rel=1e-6) and rows[1].error == pytest.approx(sigma * math.hypot(1, 1 + c[0] + c[3]), rel=1e-6)


def test_order_grid_keeps_failures(spark):
    got = E.order_grid(monthly(spark, {"ok": seasonal(3), "flat": [7.0] * 60, "short": seasonal(4, 17), "tiny": seasonal(4, 10)}).select("serie", "t", "y")).collect()
    by = {(r.serie, r.Rezagos): r for r in got}
    assert len(by) == 3 * len(E.GRID) and sum(r.Elegido for r in got if r.serie == "ok") == 1
    assert all(r.Error == E.SINGULAR_TEXT and r.AIC is None and not r.Elegido for r in got if r.serie == "flat")
    assert by["short", "1+2+3+12"].Error == E.SHORT_TEXT and by["short", "1"].Error is None
    y = np.array(seasonal(3))
    t = np.arange(13, 120)
    X = np.column_stack([y[t - 1], y[t - 12], np.ones(len(t))])
    sse = float(((y[t] - X @ np.linalg.lstsq(X, y[t], rcond=None)[0]) ** 2).sum())
    assert by["ok", "1+12"].AIC == pytest.approx(len(t) * math.log(sse / len(t)) + 6, rel=1e-6)
