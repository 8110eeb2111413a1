"""Cleaning-and-conforming operators: dedupe, orphans, calendar, quality
report, exact allocation, upsert.  All are DataFrame compositions; dimension
key sets are joined (semi/anti/left), never collected to the driver."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialise

# Spanish month names of the calendar dimension.
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
               "Septiembre", "Octubre", "Noviembre", "Diciembre"]


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under a total order (add a tie-break)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedupe_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key is missing from the dimension (left anti join)."""
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("_k")).distinct()
    return fact.join(keys, fact[fact_key] == keys["_k"], "left_anti")


def flag_orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                 flag: str = "_orphan", small_dim: bool = False) -> DataFrame:
    """Left join on the distinct dimension keys and flag the misses.

    ``small_dim``: the dimension has a known fixed size (e.g. a code list), so
    its keys are broadcast; otherwise AQE picks the strategy from runtime
    sizes."""
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("_k"), F.lit(True).alias("_hit")).distinct()
    if small_dim:
        keys = F.broadcast(keys)
    return (fact.join(keys, fact[fact_key] == keys["_k"], "left")
                .withColumn(flag, F.col("_hit").isNull() & F.col(fact_key).isNotNull()
                            | F.col(fact_key).isNull())
                .drop("_k", "_hit"))


def resolve_orphans(fact: DataFrame, dim: DataFrame, fact_key: str, default,
                    dim_key: str | None = None, flag: str | None = None, small_dim: bool = False) -> DataFrame:
    """Replace keys missing from the dimension with ``default`` (a literal or
    a Column such as a channel-dependent rule)."""
    f = flag or "_orphan"
    x = flag_orphans(fact, dim, fact_key, dim_key, f, small_dim)
    d = default if isinstance(default, Column) else F.lit(default)
    x = x.withColumn(fact_key, F.when(F.col(f), d).otherwise(F.col(fact_key)))
    return x if flag else x.drop(f)


def observed_date_range(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """min/max date over several (DataFrame, column) pairs: one row."""
    parts = [df.select(F.min(c).alias("dmin"), F.max(c).alias("dmax")) for df, c in sources]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("dmin").alias("dmin"), F.max("dmax").alias("dmax"))


def build_calendar(date_range: DataFrame, pad_days: int = 120) -> DataFrame:
    """Daily calendar from Jan 1 of the first year to last date + pad."""
    start = F.make_date(F.year("dmin"), F.lit(1), F.lit(1))
    end = F.date_add("dmax", pad_days)
    days = date_range.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("Fecha"))
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return days.select(
        (F.year("Fecha") * 10000 + F.month("Fecha") * 100 + F.dayofmonth("Fecha")).alias("DateKey"),
        "Fecha",
        F.year("Fecha").alias("Anio"),
        F.month("Fecha").alias("MesNumero"),
        F.element_at(names, F.month("Fecha")).alias("MesNombre"),
        F.substring(F.element_at(names, F.month("Fecha")), 1, 3).alias("MesCorto"),
        F.concat(F.lit("T"), F.quarter("Fecha").cast("string")).alias("Trimestre"),
        F.when(F.month("Fecha") <= 6, "S1").otherwise("S2").alias("Semestre"),
        F.when(F.dayofweek("Fecha").isin(1, 7), 1).otherwise(0).alias("EsFinDeSemana"),
    )


def quality_metrics(table: str, raw_count: Column, curated_count: Column, changed_cells: Column,
                    orphans_found: Column, orphans_resolved: Column) -> list[Column]:
    return [F.lit(table).alias("tabla"), raw_count.alias("registros_leidos"),
            curated_count.alias("registros_curados"),
            changed_cells.alias("inconsistencias_corregidas"),
            orphans_found.alias("claves_huerfanas_detectadas"),
            orphans_resolved.alias("claves_huerfanas_resueltas")]


def quality_report(per_table: list[DataFrame]) -> DataFrame:
    """Stack per-table metric rows and append the totals row with the
    referential integrity rate (resolved / found)."""
    u = per_table[0]
    for p in per_table[1:]:
        u = u.unionByName(p)
    num = ["registros_leidos", "registros_curados", "inconsistencias_corregidas",
           "claves_huerfanas_detectadas", "claves_huerfanas_resueltas"]
    tot = u.agg(*[F.sum(c).cast("long").alias(c) for c in num]).select(F.lit("TOTAL").alias("tabla"), *num)
    out = u.select("tabla", *[F.col(c).cast("long").alias(c) for c in num]).unionByName(tot)
    found, res = F.col("claves_huerfanas_detectadas"), F.col("claves_huerfanas_resueltas")
    return out.withColumn("tasa_integridad_pct", F.when(found == res, F.lit(100.0))
                          .otherwise(F.round(res * 100.0 / F.greatest(found, F.lit(1)), 2)))


def allocate_exact(amounts: DataFrame, weights: DataFrame, keys: list[str], member: str,
                   amount: str, weight: str, out: str = "asignado") -> DataFrame:
    """Split each amount over members by weight, rounded to cents; the last
    member (by ``member`` order) takes the residual so totals close exactly.

    Weights of keys without an amount take no part; an amount whose key has no weights
    stays whole, in one row without a member, so totals close in any case."""
    j = amounts.join(weights, keys, "left")
    amt = F.col(amount).cast("decimal(18,2)")
    share = F.round(amt * F.col(weight).cast("decimal(18,8)"), 2).cast("decimal(18,2)")
    grp = keys + [c for c in amounts.columns if c not in keys and c != amount]
    w_all = Window.partitionBy(*grp)
    w_last = Window.partitionBy(*grp).orderBy(F.col(member).desc())
    j = j.withColumn("_share", share).withColumn("_rk", F.row_number().over(w_last))
    others = F.sum(F.when(F.col("_rk") > 1, F.col("_share")).otherwise(F.lit(0))).over(w_all)
    return (j.withColumn(out, F.when(F.col("_rk") == 1, amt - others).otherwise(F.col("_share")))
             .drop("_share", "_rk"))


def upsert_rows(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Delete base rows whose key appears in ``updates`` and append updates."""
    return base.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)


def unpivot_months(df: DataFrame, ids: list[str], month_cols: list[str], measure_sep: str = "_",
                   month_names: list[str] | None = None) -> DataFrame:
    """Wide plan (``Ene_Vol``, ``Ene_Ing`` ...) -> tidy rows (month, measure
    columns).  Month order follows ``month_names``."""
    long = df.unpivot(ids, month_cols, "col", "value")
    parts = F.split("col", measure_sep)
    long = long.select(*ids, F.element_at(parts, 1).alias("mes"), F.element_at(parts, 2).alias("medida"),
                       "value")
    names = month_names or [m[:3] for m in MONTH_NAMES]
    mnum = F.array_position(F.array(*[F.lit(m) for m in names]), F.col("mes")).cast("int")
    measures = sorted({c.split(measure_sep)[1] for c in month_cols})
    return long.withColumn("MesNumero", mnum).groupBy(*ids, "MesNumero").pivot("medida", measures).agg(
        F.sum("value"))


def default_date(c, default: _dt.date) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def season_weights(weights: DataFrame, months: list[int], high: str = "en_temporada") -> DataFrame:
    """One row per key, member and month from weights given for the season and the
    rest of the year (boolean column ``high``)."""
    rest = [m for m in range(1, 13) if m not in months]
    month = F.when(F.col(high), F.array(*[F.lit(m) for m in months])).otherwise(F.array(*[F.lit(m) for m in rest]).cast("array<int>"))
    return weights.withColumn("Mes", F.explode(month)).drop(high)


def split_union(df: DataFrame, condition: Column, process) -> DataFrame:
    """Rows that meet ``condition`` go through ``process``, the others stay; the
    results are put together by column name."""
    return process(df.filter(condition)).unionByName(df.filter(~condition | condition.isNull()))


def cast_columns(df: DataFrame, types: dict[str, str | tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to the given types: (typed rows, rejects).

    ``types``: column -> type, or (type, pattern) where only texts that match the pattern as a whole count as of that
    type.  A text that cannot be cast becomes null and is counted in the rejects (columna, valor, celdas); nulls are no
    rejects.  Rows are cast and their failures noted in one pass, which is written; both results read that."""
    def parsed(c: str, t) -> Column:
        kind, pattern = t if isinstance(t, tuple) else (t, None)
        value = F.col(c).cast("string")
        one = value.try_cast(kind)
        return one if pattern is None else F.when(value.rlike(f"^(?:{pattern})$"), one)

    failed = [F.when(F.col(c).isNotNull() & parsed(c, t).isNull(), F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor"))) for c, t in types.items()]
    rows = materialise(df.select(*(parsed(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns),
                                 F.filter(F.array(*failed), lambda f: f.isNotNull()).alias("_rechazos")))
    rejects = rows.select(F.explode("_rechazos").alias("r")).groupBy("r.columna", "r.valor").agg(F.count(F.lit(1)).alias("celdas"))
    return rows.drop("_rechazos"), rejects
