"""Double machine learning for the effect of discount on volume.

Treatment D = line discount (percent), outcome Y = ln(quantity),
confounders = product type x market segment x year.  Nuisance models are the
confounder-cell means (an exact, SQL-expressible learner), fitted and
predicted in-sample as the source does; then the orthogonal regression of
the outcome residual on the treatment residual (no intercept), the source's
standard error sqrt(mean(e^2) / sum(d^2)), normal p-value, 95 % interval,
the naive OLS slope and the share of confounding bias removed.

Every figure follows from the moments of the cells (count, sums, products), so
one groupBy with map-side partial sums reads the lines once and nothing is
joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import norm_cdf
from ledgerlake.plans.series import _ncdf_sql
from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources.tables import read, small

CELLS = ["p_type", "c_mktsegment", "anio"]


def dml_frame(spark, d: str, *extra: Column) -> DataFrame:
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_shipdate")
    o = read(spark, d, "orders", "o_orderkey", "o_custkey")
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    p = read(spark, d, "part", "p_partkey", "p_type")
    oc = o.join(small(c, d, "customer", 32), o.o_custkey == c.c_custkey).select("o_orderkey", "c_mktsegment")
    j = (li.join(small(oc, d, "orders", 32), li.l_orderkey == oc.o_orderkey)
         .join(small(p, d, "part", 40), li.l_partkey == p.p_partkey))
    return j.select("p_type", "c_mktsegment", F.year("l_shipdate").alias("anio"),
                    (F.col("l_discount") * 100).alias("D"), F.log("l_quantity").alias("Y"), *extra)


def cell_moments(df: DataFrame, cells=CELLS) -> DataFrame:
    """Count, sums and products of D and Y per confounder cell."""
    d, y = F.col("D"), F.col("Y")
    return df.filter(d.isNotNull() & y.isNotNull()).groupBy(*cells).agg(
        F.count(F.lit(1)).alias("n"), F.sum(d).alias("sd"), F.sum(y).alias("sy"),
        F.sum(d * d).alias("sdd"), F.sum(d * y).alias("sdy"), F.sum(y * y).alias("syy"))


def dml_ate(moments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Orthogonal effect from cell moments: products around the cell means give
    theta and its error, products around the group's means the naive slope."""
    by = by or []
    n = F.col("n")
    around = moments.select(*by, "n", "sd", "sy", "sdd", "sdy", (F.col("sdd") - F.col("sd") ** 2 / n).alias("dd"),
                            (F.col("sdy") - F.col("sd") * F.col("sy") / n).alias("dy"), (F.col("syy") - F.col("sy") ** 2 / n).alias("yy"))
    g = around.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "sd", "sy", "sdd", "sdy", "dd", "dy", "yy")])
    return _effect(g, by)


def _effect(g: DataFrame, by: list[str]) -> DataFrame:
    """Effect, error, interval and naive slope from the sums of one row per group."""
    n = F.col("n")
    theta = F.col("dy") / F.col("dd")
    naive = (F.col("sdy") - F.col("sd") * F.col("sy") / n) / (F.col("sdd") - F.col("sd") ** 2 / n)
    mse = (F.col("yy") - 2 * theta * F.col("dy") + theta ** 2 * F.col("dd")) / n
    j = g.select(*by, "n", theta.alias("theta"), naive.alias("naive"), F.sqrt(mse / F.col("dd")).alias("se"))
    se = F.col("se")
    p = 2 * (1 - norm_cdf(F.abs(F.col("theta") / se)))
    return j.select(*by, F.round("theta", 8).alias("CoeficienteEstimado"), F.round(se, 8).alias("ErrorEstandar"),
                    F.round(F.col("theta") - 1.96 * se, 8).alias("IC_95_Inferior"),
                    F.round(F.col("theta") + 1.96 * se, 8).alias("IC_95_Superior"),
                    F.round(p, 6).alias("P_Valor"), (p < 0.05).alias("Significativo_P05"),
                    F.round("naive", 8).alias("Benchmark_OLS_Ingenuo"),
                    F.round((F.col("naive") - F.col("theta")) / F.col("naive") * 100, 6).alias("SesgoEliminadoPct"), "n")


_DML_CTES = ["""f AS (SELECT p_type, c_mktsegment, year(l_shipdate) AS anio, l_discount * 100 AS D, ln(l_quantity) AS Y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey)""",
             """m AS (SELECT p_type, c_mktsegment, anio, avg(D) AS md, avg(Y) AS my FROM f GROUP BY 1, 2, 3)""",
             """r AS (SELECT f.p_type, D, Y, D - md AS dt, Y - my AS yt FROM f JOIN m USING (p_type, c_mktsegment, anio))"""]


_RESULT_SQL = f"""SELECT {{k}}
  round(theta, 8) AS CoeficienteEstimado, round(se, 8) AS ErrorEstandar, round(theta - 1.96 * se, 8) AS IC_95_Inferior,
  round(theta + 1.96 * se, 8) AS IC_95_Superior, round(2 * (1 - {_ncdf_sql('abs(theta / se)')}), 6) AS P_Valor,
  2 * (1 - {_ncdf_sql('abs(theta / se)')}) < 0.05 AS Significativo_P05,
  round(naive, 8) AS Benchmark_OLS_Ingenuo, round((naive - theta) / naive * 100, 6) AS SesgoEliminadoPct, n
FROM s"""


def _dml_sql(by: str | None) -> str:
    k = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    join = f" JOIN t USING ({by})" if by else ", t"
    return with_ctes(*_DML_CTES, f"""t AS (SELECT {k}sum(dt * yt) / sum(dt * dt) AS theta, sum(dt * dt) AS sdd, count(*) AS n,
         regr_slope(Y, D) AS naive FROM r{grp})""",
                     f"""s AS (SELECT {k}theta, sdd, n, naive, sqrt(avg((yt - theta * dt) ^ 2) / sdd) AS se
         FROM r{join}{grp.replace('GROUP BY ' + by, 'GROUP BY ' + by + ', theta, sdd, n, naive') if by else ' GROUP BY theta, sdd, n, naive'})""") + _RESULT_SQL.format(k=k)


@query("dml_ate", _dml_sql(None))
def q_dml_ate(spark, d):
    return dml_ate(cell_moments(dml_frame(spark, d)))


@query("segment_ate", _dml_sql("p_type"))
def q_segment_ate(spark, d):
    """The same estimator per product type (one group per segment)."""
    return dml_ate(cell_moments(dml_frame(spark, d)), ["p_type"])


# ---------------------------------------------------------------------------
# Cross-fitting: every row's nuisance values come from the other folds
# ---------------------------------------------------------------------------

FOLDS = 5


def fold_sql(*ids: str, folds: int = FOLDS) -> str:
    """Fold of a row from its integer keys, the same text for Spark and DuckDB."""
    mixed = " + ".join(f"({c} % 2147483647) * {m}" for c, m in zip(ids, (48271, 16807, 69621), strict=False))
    return f"CAST((({mixed}) % 2147483647) % {folds} AS INT)"


def cross_fitted_cells(df: DataFrame, cells=CELLS, by: list[str] | None = None) -> DataFrame:
    """Effect with cell means of the other folds as nuisance models (columns D, Y, ``fold``, ``cells``).

    One groupBy by cell and fold reads the rows; the means of the other folds are differences of sums, and the
    products of the residuals follow from the moments.  A cell that no other fold has takes the other
    folds' mean over all cells.  ``by`` must be among ``cells``."""
    by = by or []
    m = cell_moments(df, [*cells, "fold"])
    whole = Window.partitionBy(*cells)  # a cell has one row per fold
    folds = m.groupBy("fold").agg(*[F.sum(c).alias(f"f_{c}") for c in ("n", "sd", "sy")])
    totals = folds.agg(*[F.sum(f"f_{c}").alias(f"t_{c}") for c in ("n", "sd", "sy")])
    m = m.join(F.broadcast(folds.crossJoin(totals)), "fold")  # one row per fold, and one
    others = {c: F.sum(c).over(whole) - F.col(c) for c in ("n", "sd", "sy")}
    m = m.withColumns({f"o_{c}": e for c, e in others.items()})
    mean = lambda c: F.when(F.col("o_n") > 0, F.col(f"o_{c}") / F.col("o_n")).otherwise((F.col(f"t_{c}") - F.col(f"f_{c}")) / F.nullif(F.col("t_n") - F.col("f_n"), F.lit(0)))
    m = m.withColumns({"md": mean("sd"), "my": mean("sy")})
    n, md, my, sd, sy = (F.col(c) for c in ("n", "md", "my", "sd", "sy"))
    m = m.withColumns({"dd": F.col("sdd") - 2 * md * sd + n * md * md, "dy": F.col("sdy") - md * sy - my * sd + n * md * my,
                       "yy": F.col("syy") - 2 * my * sy + n * my * my})
    return _effect(m.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "sd", "sy", "sdd", "sdy", "dd", "dy", "yy")]), by)


def cross_fitted(df: DataFrame, features: str, learner, folds: int = FOLDS) -> DataFrame:
    """Effect with models of ``pyspark.ml`` as nuisance models: ``learner(label)`` gives an estimator for a column, which
    is fitted on the other folds (columns D, Y, ``fold`` and the vector ``features``) and predicts the fold's rows.  The predictions of
    all folds are written; the moments of the residuals are one aggregate."""
    df = materialise(df.where("D IS NOT NULL AND Y IS NOT NULL").select("D", "Y", "fold", features))
    parts = None
    for k in range(folds):
        train, test = df.where(F.col("fold") != k), df.where(F.col("fold") == k)
        for label in ("D", "Y"):
            test = learner(label).setFeaturesCol(features).setLabelCol(label).setPredictionCol(f"hat_{label}").fit(train).transform(test)
        test = test.select("D", "Y", (F.col("D") - F.col("hat_D")).alias("rd"), (F.col("Y") - F.col("hat_Y")).alias("ry"))
        parts = test if parts is None else parts.unionByName(test)
    products = {"sd": "D", "sy": "Y", "sdd": "D * D", "sdy": "D * Y", "dd": "rd * rd", "dy": "rd * ry", "yy": "ry * ry"}
    return _effect(parts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(e)).alias(c) for c, e in products.items()]), [])


def fold_frame(spark, d: str) -> DataFrame:
    """The lines with their folds."""
    return dml_frame(spark, d, F.expr(fold_sql("l_orderkey", "l_linenumber")).alias("fold"))


def _cross_sql(by: str | None) -> str:
    """Row by row: residuals against the means of the other folds."""
    k, grp = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    cells = "p_type, c_mktsegment, anio"
    return with_ctes(f"""f AS MATERIALIZED (SELECT p_type, c_mktsegment, year(l_shipdate) AS anio, l_discount * 100 AS D, ln(l_quantity) AS Y, {fold_sql('l_orderkey', 'l_linenumber')} AS fold
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)""",
                     f"""own AS MATERIALIZED (SELECT {cells}, fold, avg(o.D) AS md, avg(o.Y) AS my FROM (SELECT DISTINCT {cells}, fold FROM f) c JOIN f o USING ({cells}) WHERE o.fold <> c.fold GROUP BY ALL)""".replace(
                         "SELECT p_type, c_mktsegment, anio, fold, avg", "SELECT p_type, c_mktsegment, anio, c.fold, avg"),
                     """rest AS (SELECT k.fold, avg(o.D) AS md, avg(o.Y) AS my FROM (SELECT DISTINCT fold FROM f) k JOIN f o ON o.fold <> k.fold GROUP BY ALL)""",
                     f"""r AS (SELECT {k}f.D, f.Y, f.D - coalesce(own.md, rest.md) AS dt, f.Y - coalesce(own.my, rest.my) AS yt
  FROM f LEFT JOIN own USING ({cells}, fold) JOIN rest USING (fold))""",
                     f"""t AS (SELECT {k}sum(dt * yt) / sum(dt * dt) AS theta, regr_slope(Y, D) AS naive FROM r{grp})""",
                     f"""s AS (SELECT {k}max(theta) AS theta, max(naive) AS naive, count(*) AS n, sqrt(avg((yt - theta * dt) ^ 2) / sum(dt * dt)) AS se FROM r {f'JOIN t USING ({by})' if by else 'CROSS JOIN t'}{grp})"""
                     ) + _RESULT_SQL.format(k=k)


@query("dml_cross_fitted", _cross_sql(None))
def q_dml_cross_fitted(spark, d):
    """Effect of the discount on volume, each row against the means of the other folds."""
    return cross_fitted_cells(fold_frame(spark, d))


@query("segment_cross_fitted", _cross_sql("p_type"))
def q_segment_cross_fitted(spark, d):
    """The same per product type."""
    return cross_fitted_cells(fold_frame(spark, d), by=["p_type"])
