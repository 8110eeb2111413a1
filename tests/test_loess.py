"""Local regression and decomposition against plain weighted least squares, point by point."""

import math
import random

import numpy as np

from ledgerlake.operators import loess as L


def line(xs, ys, span, at):
    """Local line at ``at`` by weighted least squares over the nearest points."""
    n = len(xs)
    m = min(n, span)
    left = max(0, min(int(round(at - xs[0])) - span // 2, n - m))
    x, y = np.array(xs[left:left + m], float), np.array(ys[left:left + m], float)
    h = max(at - x[0], x[-1] - at) + max(0, span - n) // 2
    r = np.abs(x - at)
    w = np.where(r > 0.999 * h, 0.0, np.where(r <= 0.001 * h, 1.0, (1 - (r / h if h else r) ** 3) ** 3))
    if (w > 0).sum() < 2:
        return float(y[w > 0][0]) if (w > 0).any() else float(y[np.argmin(r)])
    X = np.column_stack([np.ones(m), x - at])
    return float(np.linalg.lstsq(X * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0][0])


def plain(ys, passes=2):
    n, p = len(ys), L.PERIOD
    trend = np.zeros(n)
    for _ in range(passes):
        c = np.zeros(n + 2 * p)
        for month in range(p):
            sub = [ys[t] - trend[t] for t in range(month, n, p)]
            xs = list(range(len(sub)))
            for i in range(-1, len(sub) + 1):
                c[p + month + i * p] = line(xs, sub, L.SEASONAL, i)
        mean = lambda v, k: np.convolve(v, np.ones(k) / k, "valid")
        low = mean(mean(mean(c, p), p), 3)
        low = np.array([line(range(n), low, L.LOW_PASS, t) for t in range(n)])
        season = c[p:p + n] - low
        flat = ys - season
        trend = np.array([line(range(n), flat, L.TREND, t) for t in range(n)])
    return trend, season


def test_twenty_series(spark):
    rng = random.Random(1)
    series = {f"s{k}": np.array([200 + 2 * t + 30 * math.sin(2 * math.pi * (t + k) / 12) + rng.gauss(0, 4) for t in range(24 + 3 * k)]) for k in range(20)}
    rows = [(k, t, t % 12 + 1, float(v)) for k, ys in series.items() for t, v in enumerate(ys)]
    rows += [("short", t, t % 12 + 1, 1.0) for t in range(23)] + [("gap", t, t % 12 + 1, 1.0) for t in range(40) if t != 17]
    got = {}
    for r in L.decompose(spark.createDataFrame(rows, "serie string, t int, Mes int, y double")).collect():
        got.setdefault(r.serie, {})[r.t] = (r.tendencia, r.estacional, r.resto)
    assert set(got) == set(series)
    for k, ys in series.items():
        trend, season = plain(ys)
        t, s, rest = (np.array([got[k][i][j] for i in range(len(ys))]) for j in range(3))
        assert np.allclose(t, trend, atol=1e-7) and np.allclose(s, season, atol=1e-7) and np.allclose(t + s + rest, ys)


def test_line_is_kept_and_short_series(spark):
    df = spark.createDataFrame([("a", t, 3.0 * t + 1) for t in range(30)] + [("b", 0, 5.0), ("c", 0, 1.0), ("c", 1, 2.0)], "g string, t int, v double")
    got = {(r.g, r.t): r for r in L.loess(df, ["g"], "t", "v", 7, "o", fewest=1, outside=True).collect()}
    assert all(abs(got["a", t].o - (3 * t + 1)) < 1e-9 for t in range(30)) and abs(got["a", 0].o_before + 2) < 1e-9 and abs(got["a", 29].o_after - 91) < 1e-9
    assert got["b", 0].o == got["b", 0].o_before == got["b", 0].o_after == 5.0
    assert all(r.o is None for r in L.loess(df.where("g <> 'a'"), ["g"], "t", "v", 7, "o").collect())


def test_season_is_recovered(spark):
    rng = random.Random(2)
    rows = [("s", t, t % 12 + 1, 100 + t + 10 * math.sin(2 * math.pi * t / 12) + rng.gauss(0, 1)) for t in range(72)]
    x = L.decompose(spark.createDataFrame(rows, "serie string, t int, Mes int, y double")).collect()
    level = sum(r.tendencia for r in x) / len(x)
    index = {m: 1 + sum(r.estacional for r in x if r.Mes == m) / 6 / level for m in range(1, 13)}
    assert abs(sum(index.values()) / 12 - 1) < 0.01 and max(index.values()) > 1.05 and min(index.values()) < 0.95
