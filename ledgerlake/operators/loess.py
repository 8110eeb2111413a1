"""Local regression and seasonal decomposition of many evenly spaced series.

With even spacing the local regression at a place is a fixed linear filter: its weights
depend only on the place within the window of the nearest points, at the edges too.  So it is
a window of neighbours times a row of constants, and runs for all series at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialise

#: Spans of the decomposition: season (years), low pass, trend (months).
SEASONAL, LOW_PASS, TREND, PERIOD = 7, 13, 23, 12


def filter_weights(span: int, points: int, place: int) -> list[float]:
    """Weights of ``points`` neighbours (0, 1, ...) for the local line's value at ``place``, which may lie one step outside:
    tricube weights over the distance of the farthest neighbour, more where there are fewer points than the span."""
    h = max(place, points - 1 - place) + max(0, span - points) // 2
    w = []
    for j in range(points):
        r = abs(j - place)
        w.append(0.0 if r > 0.999 * h else 1.0 if r <= 0.001 * h else (1 - (r / h) ** 3) ** 3)
    total = sum(w)
    if total <= 0:
        return [1.0 if j == min(max(place, 0), points - 1) else 0.0 for j in range(points)]
    w = [v / total for v in w]
    mean = sum(v * j for j, v in enumerate(w))
    spread = sum(v * (j - mean) ** 2 for j, v in enumerate(w))
    if spread ** 0.5 > 0.001 * max(points - 1, 1):
        w = [v * ((place - mean) / spread * (j - mean) + 1) for j, v in enumerate(w)]
    return w


def _sizes(span: int, fewest: int) -> list[int]:
    return list(range(min(fewest, span), span + 1))


def loess(df: DataFrame, by: list[str], order: str, value: str, span: int, out: str, fewest: int | None = None, outside: bool = False) -> DataFrame:
    """``df`` with ``out``, the local line of ``value`` (never null) over the ``span`` nearest rows (odd) of its series.

    ``fewest``: least length of a series (default: the span); shorter ones get null.  ``outside`` adds
    ``out_before`` on the first row of a series and ``out_after`` on its last: the values one step beyond."""
    w = Window.partitionBy(*by).orderBy(order)
    sizes = _sizes(span, fewest or span)
    # places -1 to m of a window of m points
    table = F.array(*[F.array(*[F.array(*map(F.lit, filter_weights(span, m, c))) for c in range(-1, m + 1)]) for m in sizes])
    x = df.withColumns({"_k": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*by)),
                        "_near": F.collect_list(value).over(w.rowsBetween(-(span - 1), span - 1))})
    x = x.withColumn("_m", F.least("_n", F.lit(span)))
    x = x.withColumn("_left", F.greatest(F.lit(0), F.least(F.col("_k") - span // 2, F.col("_n") - F.col("_m"))))
    first = F.greatest(F.lit(0), F.col("_k") - (span - 1))

    def at(left: Column, place: Column) -> Column:
        weights = F.get(F.get(table, (F.col("_m") - sizes[0]).cast("int")), (place + 1).cast("int"))
        points = F.slice("_near", (left - first + 1).cast("int"), F.col("_m").cast("int"))
        return F.when(F.col("_m") >= sizes[0], F.aggregate(F.zip_with(points, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))

    added = {out: at(F.col("_left"), F.col("_k") - F.col("_left"))}
    if outside:
        added[f"{out}_before"] = F.when(F.col("_k") == 0, at(F.lit(0), F.lit(-1)))
        added[f"{out}_after"] = F.when(F.col("_k") == F.col("_n") - 1, at(F.col("_n") - F.col("_m"), F.col("_m")))
    return x.withColumns(added).drop("_k", "_n", "_near", "_m", "_left")


def decompose(series: DataFrame, passes: int = 2) -> DataFrame:
    """Seasonal decomposition by local regression (serie, t, Mes, y): adds ``tendencia``, ``estacional`` and ``resto``.

    Each pass smooths every calendar month over the years, one year beyond either end; takes out what a low pass (means over 12, 12 and 3
    months, then a local line) leaves of it; and smooths the rest to the trend.  Series with gaps or of fewer than two years get no rows."""
    whole = Window.partitionBy("serie")
    x = series.select("serie", "t", "Mes", F.col("y").cast("double").alias("y")).where("y IS NOT NULL")
    x = x.withColumns({"_n": F.count(F.lit(1)).over(whole), "_span": F.max("t").over(whole) - F.min("t").over(whole) + 1})
    x = materialise(x.where(f"_n = _span AND _n >= {2 * PERIOD}").drop("_n", "_span").withColumn("tendencia", F.lit(0.0)))
    w = Window.partitionBy("serie").orderBy("t")
    for _ in range(passes):
        d = loess(x.withColumn("_d", F.col("y") - F.col("tendencia")), ["serie", "Mes"], "t", "_d", SEASONAL, "c", fewest=1, outside=True)
        spread = F.array(*[F.struct((F.col("t") + k).alias("t"), F.col(c).alias("c")) for k, c in ((-PERIOD, "c_before"), (0, "c"), (PERIOD, "c_after"))])
        wide = d.select("serie", "Mes", "y", F.col("t").alias("t0"), F.inline(spread)).where("c IS NOT NULL")
        for name, source, n in (("_a", "c", PERIOD), ("_b", "_a", PERIOD), ("_l", "_b", 3)):
            wide = wide.withColumn(name, F.avg(source).over(w.rowsBetween(0, n - 1)))
        wide = wide.withColumn("_l", F.lag("_l", PERIOD).over(w)).where("t = t0").drop("t0", "_a", "_b")
        low = loess(wide, ["serie"], "t", "_l", LOW_PASS, "_low")
        flat = low.withColumn("estacional", F.col("c") - F.col("_low")).withColumn("_f", F.col("y") - F.col("estacional"))
        x = materialise(loess(flat, ["serie"], "t", "_f", TREND, "tendencia").select("serie", "t", "Mes", "y", "tendencia", "estacional"))
    return x.withColumn("resto", F.col("y") - F.col("tendencia") - F.col("estacional"))


# ---------------------------------------------------------------------------
# The same as DuckDB text
# ---------------------------------------------------------------------------

def loess_sql(source: str, by: str, value: str, span: int, out: str, fewest: int | None = None, outside: bool = False) -> str:
    sizes = _sizes(span, fewest or span)
    rows = lambda m: "[" + ", ".join("[" + ", ".join(repr(v) for v in filter_weights(span, m, c)) + "]" for c in range(-1, m + 1)) + "]"
    table = "CASE mm " + " ".join(f"WHEN {m} THEN {rows(m)}" for m in sizes) + " END"
    dot = lambda left, place: f"list_dot_product(near[({left}) - greatest(0, kk - {span - 1}) + 1:({left}) - greatest(0, kk - {span - 1}) + mm]::DOUBLE[], tab[({place}) + 2]::DOUBLE[])"
    extra = ""
    if outside:
        extra = f", CASE WHEN kk = 0 THEN {dot('0', '-1')} END AS {out}_before, CASE WHEN kk = nn - 1 THEN {dot('nn - mm', 'mm')} END AS {out}_after"
    return f"""SELECT * EXCLUDE (kk, nn, near, mm, ll, tab), {dot('ll', 'kk - ll')} AS {out}{extra} FROM (
  SELECT *, greatest(0, least(kk - {span // 2}, nn - mm)) AS ll, {table} AS tab FROM (
    SELECT *, least(nn, {span}) AS mm FROM (
      SELECT *, row_number() OVER w - 1 AS kk, count(*) OVER (PARTITION BY {by}) AS nn,
             list({value}) OVER (w ROWS BETWEEN {span - 1} PRECEDING AND {span - 1} FOLLOWING) AS near FROM ({source}) s0 WINDOW w AS (PARTITION BY {by} ORDER BY t)) s1) s2) s3 WHERE mm >= {sizes[0]}"""


def decompose_sql(name: str, source: str, passes: int = 2) -> str:
    """CTEs ``name``: serie, t, Mes, y, tendencia, estacional."""
    ctes = [f"""{name}_0 AS MATERIALIZED (
  SELECT serie, t, Mes, y, 0.0::DOUBLE AS tendencia FROM (SELECT *, count(*) OVER s AS n, max(t) OVER s - min(t) OVER s + 1 AS span FROM {source} WINDOW s AS (PARTITION BY serie)) q
  WHERE n = span AND n >= {2 * PERIOD})"""]
    for k in range(passes):
        ctes.append(f"{name}_{k}d AS MATERIALIZED ({loess_sql(f'SELECT *, y - tendencia AS dd FROM {name}_{k}', 'serie, Mes', 'dd', SEASONAL, 'c', 1, True)})")
        ctes.append(f"""{name}_{k}w AS MATERIALIZED (
  SELECT serie, Mes, y, t AS t0, t, c FROM {name}_{k}d UNION ALL SELECT serie, Mes, y, t, t - {PERIOD}, c_before FROM {name}_{k}d WHERE c_before IS NOT NULL
  UNION ALL SELECT serie, Mes, y, t, t + {PERIOD}, c_after FROM {name}_{k}d WHERE c_after IS NOT NULL)""")
        body = f"SELECT * FROM {name}_{k}w"
        for col, src, n in (("la", "c", PERIOD), ("lb", "la", PERIOD), ("lc", "lb", 3)):
            body = f"SELECT *, avg({src}) OVER (PARTITION BY serie ORDER BY t ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS {col} FROM ({body}) x_{col}"
        body = f"SELECT serie, Mes, y, t, c, lp FROM (SELECT *, lag(lc, {PERIOD}) OVER (PARTITION BY serie ORDER BY t) AS lp FROM ({body}) x_lp) y WHERE t = t0"
        ctes.append(f"{name}_{k}l AS MATERIALIZED ({loess_sql(body, 'serie', 'lp', LOW_PASS, 'low')})")
        flat = f"SELECT serie, t, Mes, y, c - low AS estacional, y - (c - low) AS ff FROM {name}_{k}l"
        ctes.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT serie, t, Mes, y, tendencia, estacional FROM ({loess_sql(flat, 'serie', 'ff', TREND, 'tendencia')}) z)")
    ctes.append(f"{name} AS (SELECT *, y - tendencia - estacional AS resto FROM {name}_{passes})")
    return ",\n".join(ctes)
