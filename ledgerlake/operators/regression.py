"""Least squares for many series at once.

The products of all columns are summed per series in one aggregate, so only a
small matrix per series goes on; regressions on any subset of the columns are
solved from its rows and columns, series by series in Arrow batches.  Lags are
window columns: a series, bounded by its length, is one window partition.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.scalar import norm_cdf
from ledgerlake.session import materialise, ship_package

#: A candidate's normalised Gram matrix with a smaller eigenvalue counts as singular.
SINGULAR = 1e-11


def products(df: DataFrame, by: list[str], columns: list[Column], *extra: Column) -> DataFrame:
    """Per series the number of rows (``obs``) and the sums of products of all pairs of columns
    (``gram``: upper triangle by rows); ``extra`` are further aggregates."""
    pairs = [F.sum(a * b) for i, a in enumerate(columns) for b in columns[i:]]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("obs"), F.array(*pairs).alias("gram"), *extra)


def matrix(upper: list[float], size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = upper
    return full + full.T - np.diag(np.diag(full))


def fit(gram: np.ndarray, target: int, regressors: list[int]) -> tuple[np.ndarray, float, np.ndarray] | None:
    """Coefficients, residual sum of squares and inverse of the regression of column ``target``
    on ``regressors``; None if these are linearly dependent."""
    a, b = gram[np.ix_(regressors, regressors)], gram[regressors, target]
    scale = np.sqrt(np.diag(a))
    if (scale <= 0).any():
        return None
    a = a / np.outer(scale, scale)
    if np.linalg.eigvalsh(a)[0] < SINGULAR:
        return None
    inverse = np.linalg.inv(a) / np.outer(scale, scale)
    coef = inverse @ b
    return coef, max(0.0, float(gram[target, target] - coef @ b)), inverse


def solved(rows: DataFrame, by: list[str], solve: Callable[[dict], dict], added: str) -> DataFrame:
    """``solve(row)`` of every row, in Arrow batches; the columns ``by`` and those of the DDL ``added``."""
    ship_package(rows.sparkSession)
    fields = StructType.fromDDL(added)

    def run(batches):
        for batch in batches:
            out = [solve(r) for r in batch.to_pylist()]
            keys = [batch.column(batch.schema.get_field_index(k)) for k in by]
            yield pa.RecordBatch.from_arrays(keys + [pa.array([o[f.name] for o in out], type=arrow[f.name]) for f in fields],
                                             names=[*by, *fields.names])

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = {f.name: f.type for f in to_arrow_schema(fields)}
    return rows.mapInArrow(run, StructType([rows.schema[k] for k in by] + fields.fields))


# ---------------------------------------------------------------------------
# Unit roots
# ---------------------------------------------------------------------------

# Published response surfaces of the unit-root statistic with a constant
# (MacKinnon 1994), for one series and for the residual of two: limits, and polynomials of the
# normal quantile below and above the first limit.
SURFACE = {
    1: {"star": -1.61, "least": -18.83, "most": 2.74, "small": (2.1659, 1.4412, 0.038269), "large": (1.7339, 0.93202, -0.12745, -0.010368)},
    2: {"star": -2.62, "least": -18.86, "most": 0.92, "small": (2.92, 1.5012, 0.039796), "large": (2.1945, 0.64695, -0.29198, -0.042377)},
}


def unit_root_p(stat: Column, series: int = 1) -> Column:
    """p-value of a unit-root statistic on the surface of ``series`` series."""
    s = SURFACE[series]

    def poly(c):
        out = F.lit(c[-1])
        for k in reversed(c[:-1]):
            out = out * stat + F.lit(k)
        return out

    return (F.when(stat.isNull(), None).when(stat > s["most"], 1.0).when(stat < s["least"], 0.0)
            .when(stat <= s["star"], norm_cdf(poly(s["small"]))).otherwise(norm_cdf(poly(s["large"]))))


def adf(series: DataFrame, by: list[str], value: str = "y", max_lag: int = 12, constant: bool = True) -> DataFrame:
    """Augmented Dickey-Fuller test of many series (``by``, t, ``value``): by, n, rezagos, estadistico.

    The change is regressed on the lagged level, p lagged changes and a constant (``constant``).
    p is chosen by AIC among 0 to min(max_lag, 12 (n/100)^(1/4) rounded up, n/2 - 2), all on the
    months that the largest has (more than there are parameters), and the statistic taken from all months that p leaves.
    Null values are left out; too short or constant series have a null statistic.
    """
    w = Window.partitionBy(*by).orderBy("t")
    whole = Window.partitionBy(*by)
    y = F.col("_y")
    x = series.where(F.col(value).isNotNull()).select(*by, "t", F.col(value).cast("double").alias("_y"))
    x = x.withColumns({"_i": F.row_number().over(w), "n": F.count(F.lit(1)).over(whole), "d": y - F.lag("_y").over(w)})
    # with a constant the level may be shifted, which keeps the products small
    x = x.withColumn("l", F.lag("_y").over(w) - (F.first("_y").over(w) if constant else F.lit(0.0)))
    x = x.withColumns({f"d{k}": F.lag("d", k).over(w) for k in range(1, max_lag + 1)})
    most = F.least(F.lit(max_lag), F.ceil(12 * F.pow(F.col("n") / 100, 0.25)), F.floor(F.col("n") / 2) - (2 if constant else 1))
    x = materialise(x.withColumn("most", most.cast("int")).drop("_y"))
    lags = [f"d{k}" for k in range(1, max_lag + 1)]
    columns = [F.col("d"), F.col("l"), *(F.coalesce(c, F.lit(0.0)) for c in lags), F.lit(1.0)]
    size = max_lag + 3
    last = [size - 1] if constant else []

    def best(row: dict) -> dict:
        gram, n = matrix(row["gram"], size), row["obs"]
        found = []
        for p in range(row["most"] + 1):
            used = 1 + p + len(last)
            one = fit(gram, 0, [1, *range(2, 2 + p), *last]) if n > used else None
            if one is not None and one[1] > 0:
                found.append((n * math.log(one[1] / n) + 2 * used, p))
        return {"rezagos": min(found)[1] if found else None}

    def statistic(row: dict) -> dict:
        p, n = row["rezagos"], row["obs"]
        cols = [1, *range(2, 2 + p), *last]
        one = fit(matrix(row["gram"], size), 0, cols)
        if one is None or n <= len(cols) or one[1] <= 0:
            return {"estadistico": None}
        coef, sse, inverse = one
        return {"estadistico": float(coef[0] / math.sqrt(sse / (n - len(cols)) * inverse[0, 0]))}

    first = products(x.where("most >= 0 AND _i > most + 1"), by, columns, F.max("most").alias("most"))
    chosen = solved(first, by, best, "rezagos int").where("rezagos IS NOT NULL")
    again = products(x.join(chosen, by).where("_i > rezagos + 1"), by, columns, F.max("rezagos").alias("rezagos"))
    out = solved(again.withColumn("_p", F.col("rezagos")), [*by, "_p"], statistic, "estadistico double").withColumnRenamed("_p", "rezagos")
    return x.groupBy(*by).agg(F.max("n").alias("n")).join(out, by, "left").select(*by, "n", "rezagos", "estadistico")


def adf_sql(name: str, source: str, by: str, max_lag: int = 12, constant: bool = True) -> str:
    """The same as DuckDB CTEs over ``source`` (``by``, t, y), by another way: each column is freed of the
    former ones in turn (row by row), so the sums of squares of all p come from one chain."""
    lags = range(1, max_lag + 1)
    centre = (lambda c: f"{c} - avg({c}) OVER s") if constant else (lambda c: c)
    s = f"WINDOW s AS (PARTITION BY {by})"
    free = lambda c, v: f"{c} - {v} * coalesce(sum({c} * {v}) OVER s / nullif(sum({v} * {v}) OVER s, 0), 0)"
    extra = 1 if constant else 0
    ctes = [f"""{name}_b AS (
  SELECT *, least({max_lag}, CAST(ceil(12 * pow(n / 100.0, 0.25)) AS INT), n // 2 - {1 + extra}) AS most, {', '.join(f'lag(d, {k}) OVER w AS d{k}' for k in lags)}
  FROM (SELECT {by}, t, row_number() OVER w AS i, count(*) OVER (PARTITION BY {by}) AS n, y - lag(y) OVER w AS d, lag(y) OVER w AS l
        FROM {source} WHERE y IS NOT NULL WINDOW w AS (PARTITION BY {by} ORDER BY t)) z WINDOW w AS (PARTITION BY {by} ORDER BY t))"""]

    def chain(tag: str, condition: str, keep_level: bool) -> str:
        """Free d (and the level, if it comes last) of the lags in turn; returns the last table."""
        before = f"{name}_{tag}0"
        masked = [f"coalesce(CASE WHEN {k} <= {'most' if keep_level else 'rezagos'} THEN d{k} END, 0) AS d{k}" for k in lags]
        inner = f"SELECT {by}, {'most' if keep_level else 'rezagos'}, d, l, {', '.join(masked)} FROM {condition}"
        ctes.append(f"{before} AS MATERIALIZED (SELECT {by}, {'most' if keep_level else 'rezagos'}, {centre('d')} AS r0, {centre('l')} AS l, "
                    f"{', '.join(f'{centre(f'd{k}')} AS d{k}' for k in lags)} FROM ({inner}) q {s})")
        if keep_level:
            after = f"{name}_{tag}l"
            ctes.append(f"{after} AS MATERIALIZED (SELECT {by}, most, {free('r0', 'l')} AS r0, {', '.join(f'{free(f'd{k}', 'l')} AS d{k}' for k in lags)} FROM {before} {s})")
            before = after
        for k in lags:
            after = f"{name}_{tag}{k}"
            kept = ["most", *(f"r{j}" for j in range(k))] if keep_level else ["rezagos", f"{free('l', f'd{k}')} AS l"]
            r = f"{free(f'r{k - 1}', f'd{k}')} AS r{k}"
            later = [f"{free(f'd{j}', f'd{k}')} AS d{j}" for j in range(k + 1, max_lag + 1)]
            ctes.append(f"{after} AS MATERIALIZED (SELECT {by}, {', '.join([*kept, r, *later])} FROM {before} {s})")
            before = after
        return before

    table = chain("a", f"{name}_b WHERE most >= 0 AND i > most + 1", True)
    aic = " UNION ALL ".join(f"SELECT {by}, {p} AS p, count(*) * ln(sum(r{p} * r{p}) / count(*)) + {2 * (1 + p + extra)} AS aic FROM {table} GROUP BY {by} HAVING max(most) >= {p} AND count(*) > {1 + p + extra} AND sum(r{p} * r{p}) > 0"
                             for p in range(max_lag + 1))
    ctes.append(f"{name}_p AS MATERIALIZED (SELECT {by}, arg_min(p, (aic, p)) AS rezagos FROM ({aic}) q GROUP BY {by})")
    table = chain("f", f"{name}_b JOIN {name}_p USING ({by}) WHERE i > rezagos + 1", False)
    ctes.append(f"""{name} AS MATERIALIZED (
  SELECT {by}, n, rezagos, sxy / sxx / sqrt((syy - sxy * sxy / sxx) / (obs - 1 - rezagos - {extra}) / sxx) AS estadistico
  FROM (SELECT {by}, max(n) AS n FROM {name}_b GROUP BY {by}) a LEFT JOIN (
    SELECT {by}, max(rezagos) AS rezagos, count(*) AS obs, sum(r{max_lag} * l) AS sxy, sum(l * l) AS sxx, sum(r{max_lag} * r{max_lag}) AS syy
    FROM {table} GROUP BY {by}) m USING ({by}))""")
    return ",\n".join(ctes)


def ols_sql(name: str, source: str, by: str, target: str, regressors: list[str]) -> str:
    """DuckDB CTEs: ``name`` with ``by``, obs, sse and a column b_<regressor> each.  A coefficient is the slope on its
    regressor once target and regressor are freed of all others, one after the other (no solving of equations)."""
    window = f"WINDOW s AS (PARTITION BY {by})"
    free = lambda c, v: f"{c} - {v} * coalesce(sum({c} * {v}) OVER s / nullif(sum({v} * {v}) OVER s, 0), 0) AS {c}"
    ctes, found = [], []
    for j, own in enumerate(regressors):
        others, before = [r for r in regressors if r != own], source
        for i, r in enumerate(others):
            later = [*others[i + 1:], own]
            ctes.append(f"{name}_{j}_{i} AS MATERIALIZED (SELECT {by}, {', '.join(free(c, r) for c in [target, *later])} FROM {before} {window})")
            before = f"{name}_{j}_{i}"
        ctes.append(f"{name}_{j} AS MATERIALIZED (SELECT {by}, count(*) AS obs, sum({target} * {own}) / sum({own} * {own}) AS b_{own}, "
                    f"sum({target} * {target}) - sum({target} * {own}) ^ 2 / sum({own} * {own}) AS sse FROM {before} GROUP BY {by})")
        found.append(f"{name}_{j}")
    columns = ", ".join(f"{t}.b_{r}" for t, r in zip(found, regressors))
    joins = "".join(f" JOIN {t} USING ({by})" for t in found[1:])
    ctes.append(f"{name} AS MATERIALIZED (SELECT {found[0]}.{by}, {found[0]}.obs, {found[0]}.sse, {columns} FROM {found[0]}{joins})")
    return ",\n".join(ctes)
