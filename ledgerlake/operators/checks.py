"""Integrity constraints as dataset checks: each rule is one aggregate
expression counting violations, so a whole rule set over one table is a
single scan; foreign keys are left-anti joins against the distinct keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """``rules``: name -> boolean Column that is TRUE when the row is valid.
    Returns (tabla, regla, violaciones) rows (one scan for all rules)."""
    agg = df.agg(*[F.sum(F.when(cond, 0).otherwise(1)).cast("long").alias(f"r{i}")
                   for i, cond in enumerate(rules.values())])
    pairs = ", ".join(f"'{n}', r{i}" for i, n in enumerate(rules))
    return agg.select(F.lit(table).alias("tabla"),
                      F.expr(f"stack({len(rules)}, {pairs}) AS (regla, violaciones)"))


def not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def in_set(col: str, values: list) -> Column:
    return F.col(col).isin(*values)


def max_length(col: str, n: int) -> Column:
    return F.length(col) <= n


def duplicate_keys(df: DataFrame, keys: list[str], table: str, rule: str = "primary_key") -> DataFrame:
    """Number of key values that occur more than once (PK / UNIQUE)."""
    d = df.groupBy(*keys).count().filter("count > 1")
    return d.agg(F.count(F.lit(1)).cast("long").alias("violaciones")).select(
        F.lit(table).alias("tabla"), F.lit(rule).alias("regla"), "violaciones")


def foreign_key(fact: DataFrame, fk: str, dim: DataFrame, pk: str, table: str) -> DataFrame:
    keys = dim.select(F.col(pk).alias("_k")).distinct()
    miss = fact.join(keys, fact[fk] == keys["_k"], "left_anti")
    return miss.agg(F.count(F.lit(1)).cast("long").alias("violaciones")).select(
        F.lit(table).alias("tabla"), F.lit(f"foreign_key_{fk}").alias("regla"), "violaciones")


def grid_complete(df: DataFrame, dims: list[str], table: str) -> DataFrame:
    """Missing cells of the dense grid: product of distinct counts - rows."""
    prod = F.lit(1)
    for c in dims:
        prod = prod * F.countDistinct(c)
    return df.agg((prod - F.count(F.lit(1))).cast("long").alias("violaciones")).select(
        F.lit(table).alias("tabla"), F.lit("grid_complete"), "violaciones").toDF("tabla", "regla", "violaciones")


def series_gaps(months: DataFrame, month_col: str, table: str) -> DataFrame:
    """Months missing between the first and last observed month."""
    rng = months.agg(F.min(month_col).alias("a"), F.max(month_col).alias("b"))
    full = rng.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    obs = months.select(F.col(month_col).alias("m")).distinct()
    return full.join(obs, "m", "left_anti").agg(F.count(F.lit(1)).cast("long").alias("violaciones")).select(
        F.lit(table).alias("tabla"), F.lit("series_no_gaps").alias("regla"), "violaciones")


def domain_set(df: DataFrame, col: str, expected: list, table: str) -> DataFrame:
    """Values outside the expected set plus expected values that never occur."""
    have = df.select(F.col(col).alias("_v")).distinct()
    got = have.agg(F.collect_set("_v").alias("s"))  # a code list: few values
    want = F.array(*[F.lit(v) for v in expected])
    return got.select(F.lit(table).alias("tabla"), F.lit(f"domain_set_{col}").alias("regla"),
                      (F.size(F.array_except("s", want)) + F.size(F.array_except(want, F.col("s")))).cast("long").alias("violaciones"))


def totals_close(before: DataFrame, after: DataFrame, cols: list[str], table: str, within: float = 0.01) -> DataFrame:
    """Number of columns whose total a step changed by ``within`` or more."""
    a = before.agg(*[F.sum(c).alias(f"a{i}") for i, c in enumerate(cols)])
    b = after.agg(*[F.sum(c).alias(f"b{i}") for i, c in enumerate(cols)])
    off = F.lit(0)
    for i in range(len(cols)):
        off = off + (F.abs(F.col(f"a{i}") - F.col(f"b{i}")) >= within).cast("int")
    return a.crossJoin(b).select(F.lit(table).alias("tabla"), F.lit("totals_close").alias("regla"), off.cast("long").alias("violaciones"))  # one row each


def min_obs(df: DataFrame, series: list[str], least: int, table: str) -> DataFrame:
    """Series with fewer rows than ``least``."""
    n = df.groupBy(*series).count()
    return n.agg(F.count_if(F.col("count") < least).alias("violaciones")).select(
        F.lit(table).alias("tabla"), F.lit(f"min_obs_{least}").alias("regla"), "violaciones")


def in_band(df: DataFrame, value: Column, low: float, high: float, table: str, rule: str) -> DataFrame:
    """0 if an aggregate lies in [low, high], else 1."""
    return df.agg(value.alias("_v")).select(
        F.lit(table).alias("tabla"), F.lit(rule).alias("regla"), F.coalesce((~F.col("_v").between(low, high)).cast("long"), F.lit(1)).alias("violaciones"))


def ordered(df: DataFrame, cols: list[str], table: str, strict: bool = True) -> DataFrame:
    """Rows in which the columns do not rise from left to right."""
    ok = F.lit(True)
    for a, b in zip(cols, cols[1:], strict=False):
        ok = ok & ((F.col(a) < F.col(b)) if strict else (F.col(a) <= F.col(b)))
    return df.agg(F.count_if(~F.coalesce(ok, F.lit(False))).alias("violaciones")).select(
        F.lit(table).alias("tabla"), F.lit("ordering_" + "_".join(cols)).alias("regla"), "violaciones")


def missing_months(months: DataFrame, month_col: str) -> DataFrame:
    """The months missing between the first and the last one, as rows."""
    rng = months.agg(F.min(month_col).alias("a"), F.max(month_col).alias("b"))
    full = rng.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("mes"))
    return full.join(months.select(F.col(month_col).alias("mes")).distinct(), "mes", "left_anti")
