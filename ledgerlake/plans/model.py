"""Measure layer: named measures evaluated under a filter context.

``evaluate(spark, d, measures, by, where)`` compiles to one Spark plan:
each needed fact is filtered by the slicers on its own columns (a slicer on a
column a fact does not have leaves it unfiltered, as a dimension without a
relationship does), aggregated once at the ``by`` grain, the per-fact results
are full-outer joined on ``by``, and derived measures are added in
dependency layers.  Two-level measures (SUMX over products) aggregate at
``by`` + product first.  Same-period-last-year values come from the same fact
with every month key moved one year on, so they hold at any grain.  A dimension
that a fact does not have leaves it unfiltered and unsplit: its value repeats.
``remove`` names slicers that some sums ignore; ``total`` adds a row that is
evaluated again at total level.

Measure expressions are SQL text over base sums and other measures, so the
DuckDB oracle evaluates the very same definitions on its own aggregation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.plans import budget as BU
from ledgerlake.session import materialise
from ledgerlake.sources import bridge as B


@dataclass
class Fact:
    name: str
    builder: object
    sql_ctes: list
    dims: set
    aggs: dict
    table: str = ""


CUBE_DIMS = ["MesDateKey", "AnioMes", "Anio", "Mes", "Linea", "Segmento", "CanalVenta", "CentroCostoID"]
CUBE_SUMS = ["VolumenReal", "IngresosReales", "CostoReal", "MargenBrutoReal", "FacturacionBruta"]


def sales_cube(spark, d):
    """Sales summed to month x line x segment x channel x cost centre (exact
    decimal sums, so any coarser SUM equals the sum over line items).  Its
    size is bounded by the product of those dimensions, not by the number
    of line items; it is written once to the shared checkpoint folder and
    feeds every sales-derived branch of an evaluation (actuals, prior year,
    variance terms and the budget's cells)."""
    v = B.ventas(spark, d)
    return materialise(v.groupBy(*CUBE_DIMS).agg(F.min("DateKey").alias("DateKey"), *[F.sum(c).alias(c) for c in CUBE_SUMS]))


def _ventas(spark, d):
    return sales_cube(spark, d)


def _presupuesto(spark, d, cube=None):
    p = BU.budget_prior_year(cube if cube is not None else sales_cube(spark, d), write=False)
    return p.withColumnRenamed("ProductoID", "Linea")


def _gastos(spark, d):
    g = B.gastos_operativos(spark, d)
    return g.withColumn("Anio", (F.col("DateKey") / 10000).cast("int")).withColumn(
        "Mes", ((F.col("DateKey") / 100) % 100).cast("int"))


def _capital(spark, d):
    k = B.capital_trabajo(spark, d)
    return k.withColumn("Anio", (F.col("DateKey") / 10000).cast("int")).withColumn(
        "Mes", ((F.col("DateKey") / 100) % 100).cast("int"))


_TIME = {"Anio", "Mes", "AnioMes"}

FACTS = {
    "V": Fact("ventas", _ventas, [B.ventas_sql()],
              _TIME | {"Linea", "Segmento", "CanalVenta", "CentroCostoID"},
              {"vol_real": "SUM(VolumenReal)", "ing_real": "SUM(IngresosReales)",
               "costo_real": "SUM(CostoReal)", "mb_real": "SUM(MargenBrutoReal)",
               "fact_bruta": "SUM(FacturacionBruta)"}, "ventas"),
    "Y": Fact("ventas del anio anterior", None, [B.ventas_sql(), """ventas_y AS (
  SELECT * REPLACE (MesDateKey + 10000 AS MesDateKey, Anio + 1 AS Anio, CAST(Anio + 1 AS VARCHAR) || substr(AnioMes, 5) AS AnioMes)
  FROM ventas WHERE MesDateKey + 10000 <= (SELECT max(MesDateKey) FROM ventas))"""],
              _TIME | {"Linea", "Segmento", "CanalVenta", "CentroCostoID"}, {"ing_real_py": "SUM(IngresosReales)"}, "ventas_y"),
    "P": Fact("presupuesto", _presupuesto, [B.ventas_sql(), BU.budget_sql(),
                                            "presupuesto_l AS (SELECT *, ProductoID AS Linea FROM presupuesto)"],
              _TIME | {"Linea", "CentroCostoID"},
              {"vol_ppto": "SUM(VolumenPresupuestado)", "ing_ppto": "SUM(IngresosPresupuestados)",
               "costo_ppto": "SUM(CostoPresupuestado)", "mb_ppto": "SUM(MargenBrutoPresupuestado)"}, "presupuesto_l"),
    "G": Fact("gastos", _gastos, [B.GASTOS_SQL.replace(
        "gastos AS (\n  SELECT DateKey,", "gastos AS (\n  SELECT CAST(DateKey / 10000 AS INT) AS Anio, "
        "CAST(DateKey / 100 % 100 AS INT) AS Mes, DateKey,").replace(
        "GROUP BY DateKey, AnioMes", "GROUP BY CAST(DateKey / 10000 AS INT), CAST(DateKey / 100 % 100 AS INT), DateKey, AnioMes")],
              _TIME | {"CentroCostoID", "CuentaID"},
              {"opex_real": "SUM(OPEXReal)", "opex_ppto": "SUM(OPEXPresupuestado)"}, "gastos"),
    "K": Fact("capital", _capital, [B.CAPITAL_SQL.replace(
        "capital AS (\n  SELECT *,", "capital AS (\n  SELECT *, CAST(DateKey / 10000 AS INT) AS Anio, "
        "CAST(DateKey / 100 % 100 AS INT) AS Mes,")],
              _TIME,
              {"dso": "CAST(SUM(DSO_DiasCobro) AS DOUBLE) / COUNT(DSO_DiasCobro)",
               "dio": "CAST(SUM(DIO_DiasInventario) AS DOUBLE) / COUNT(DIO_DiasInventario)",
               "dpo": "CAST(SUM(DPO_DiasPago) AS DOUBLE) / COUNT(DPO_DiasPago)",
               "cxc": "SUM(CuentasPorCobrar)", "inv": "SUM(Inventario)", "cxp": "SUM(CuentasPorPagar)"}, "capital"),
}

# Spark integer division differs from DuckDB's: fix the year/month split in
# the DuckDB text (`/` is float division there, `//` integer).
for _f in ("G", "K"):
    FACTS[_f].sql_ctes = [c.replace("CAST(DateKey / 10000 AS INT)", "(DateKey // 10000)")
                           .replace("CAST(DateKey / 100 % 100 AS INT)", "((DateKey // 100) % 100)")
                          for c in FACTS[_f].sql_ctes]


def div(a: str, b: str, alt: str = "0.0") -> str:
    """DIVIDE(a, b, alt) as SQL text."""
    return f"CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN {alt} ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def z(x: str) -> str:
    return f"COALESCE({x}, 0)"


def case(value: str, rules, default: str, on_null: str | None = None) -> str:
    parts = [f"WHEN ({value}) IS NULL THEN {on_null}"] if on_null is not None else []
    parts += [f"WHEN ({value}) {op} {thr} THEN '{lab}'" for op, thr, lab in rules]
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"


# ---------------------------------------------------------------------------
# Controller measures (filter-context measures of the management P&L)
# Parameters with the source's defaults: mix 8 %, tax 35 %, delta NOF 15 %,
# CAPEX 2.5 % of revenue, WACC 12 %.
# ---------------------------------------------------------------------------
MIX, TAX, DNOF, CAPEX, WACC = 0.08, 0.35, 0.15, 0.025, 0.12

CTL = [
    ("VolumenReal", "vol_real"), ("VolumenPresupuesto", "vol_ppto"),
    ("DesvioVolumen", f"{z('VolumenReal')} - {z('VolumenPresupuesto')}"),
    ("DesvioVolumenPct", div("DesvioVolumen", "VolumenPresupuesto")),
    ("IngresosReales", "ing_real"), ("IngresosPresupuesto", "ing_ppto"),
    ("DesvioIngresos", f"{z('IngresosReales')} - {z('IngresosPresupuesto')}"),
    ("DesvioIngresosPct", div("DesvioIngresos", "IngresosPresupuesto")),
    ("PrecioPromedioReal", div("IngresosReales", "VolumenReal")),
    ("PrecioPromedioPresupuesto", div("IngresosPresupuesto", "VolumenPresupuesto")),
    ("DesvioPrecioPromedio", "PrecioPromedioReal - PrecioPromedioPresupuesto"),
    ("CostoReal", "costo_real"), ("CostoPresupuesto", "costo_ppto"),
    ("DesvioCostoTotal", f"{z('CostoReal')} - {z('CostoPresupuesto')}"),
    ("DesvioCostoPct", div("DesvioCostoTotal", "CostoPresupuesto")),
    ("CostoUnitarioReal", div("CostoReal", "VolumenReal")),
    ("CostoUnitarioPresupuesto", div("CostoPresupuesto", "VolumenPresupuesto")),
    ("DesvioCostoUnitario", "CostoUnitarioReal - CostoUnitarioPresupuesto"),
    ("MargenBrutoReal", f"{z('IngresosReales')} - {z('CostoReal')}"),
    ("MargenBrutoPresupuesto", f"{z('IngresosPresupuesto')} - {z('CostoPresupuesto')}"),
    ("DesvioMargenBrutoTotal", "MargenBrutoReal - MargenBrutoPresupuesto"),
    ("MargenBrutoPctReal", div("MargenBrutoReal", "IngresosReales")),
    ("MargenBrutoPctPresupuesto", div("MargenBrutoPresupuesto", "IngresosPresupuesto")),
    ("DesvioMargenBrutoPct", "MargenBrutoPctReal - MargenBrutoPctPresupuesto"),
    ("EfectoVolumen", z("ev")), ("EfectoPrecio", z("ep")), ("EfectoCosto", z("ec")),
    ("SumaEfectosTotales", "EfectoVolumen + EfectoPrecio + EfectoCosto"),
    ("VerificacionDesvioCuadrado", "round(DesvioMargenBrutoTotal - SumaEfectosTotales, 2) + 0.0"),
    ("EstadoCuadratura", "CASE WHEN round(VerificacionDesvioCuadrado, 2) = 0 "
                         "THEN 'CUADRATURA EXACTA ($0.00)' ELSE 'DESCUADRE DETECTADO' END"),
    ("OPEXReal", "opex_real"), ("OPEXPresupuesto", "opex_ppto"),
    ("DesvioOPEX", f"{z('OPEXReal')} - {z('OPEXPresupuesto')}"),
    ("DesvioOPEXPct", div("DesvioOPEX", "OPEXPresupuesto")),
    ("RatioOPEXIngresosReal", div("OPEXReal", "IngresosReales")),
    ("RatioOPEXIngresosPresupuesto", div("OPEXPresupuesto", "IngresosPresupuesto")),
    ("DesvioRatioOPEXPuntos", "RatioOPEXIngresosReal - RatioOPEXIngresosPresupuesto"),
    ("AlertaSemaforoOPEX", case("DesvioOPEXPct", [(">", "0.05", "[CRITICO]"), (">", "0.00", "[ALERTA]")],
                                "[EN PLAN]")),
    ("EBITDAReal", f"MargenBrutoReal - {z('OPEXReal')}"),
    ("EBITDAPresupuesto", f"MargenBrutoPresupuesto - {z('OPEXPresupuesto')}"),
    ("DesvioEBITDA", "EBITDAReal - EBITDAPresupuesto"),
    ("DesvioEBITDAPct", div("DesvioEBITDA", "abs(EBITDAPresupuesto)")),
    ("MargenEBITDAPctReal", div("EBITDAReal", "IngresosReales")),
    ("MargenEBITDAPctPresupuesto", div("EBITDAPresupuesto", "IngresosPresupuesto")),
    ("DSOPromedio", "dso"), ("DIOPromedio", "dio"), ("DPOPromedio", "dpo"),
    ("CicloConversionEfectivo", "DIOPromedio + DSOPromedio - DPOPromedio"),
    ("CuentasPorCobrarTotal", "cxc"), ("InventarioTotal", "inv"), ("CuentasPorPagarTotal", "cxp"),
    ("NOFTotal", f"{z('CuentasPorCobrarTotal')} + {z('InventarioTotal')} - {z('CuentasPorPagarTotal')}"),
    ("ActivoOperativoLiquido", f"{z('CuentasPorCobrarTotal')} + {z('InventarioTotal')}"),
    ("RatioCoberturaProveedores", div("ActivoOperativoLiquido", "CuentasPorPagarTotal")),
    ("EfectoMixCartera", f"EfectoVolumen * {MIX}"),
    ("EfectoVolumenPuro", "EfectoVolumen - EfectoMixCartera"),
    ("ImpuestoGananciasEstimado", f"EBITDAReal * {TAX}"),
    ("VariacionCapitalTrabajoDeltaNOF", f"NOFTotal * {DNOF}"),
    ("CAPEXOperativo", f"{z('IngresosReales')} * {CAPEX}"),
    ("FreeCashFlowFCFF", "EBITDAReal - ImpuestoGananciasEstimado - VariacionCapitalTrabajoDeltaNOF - CAPEXOperativo"),
    ("RotacionActivosOperativosLiq", div("IngresosReales", "ActivoOperativoLiquido")),
    ("MargenNetoOperativo", div("EBITDAReal - ImpuestoGananciasEstimado", "IngresosReales")),
    ("RetornoDuPontOperativo", "MargenNetoOperativo * RotacionActivosOperativosLiq"),
    ("ROICEstimado", div(f"EBITDAReal * (1 - {TAX})", "NOFTotal + CAPEXOperativo * 4")),
    ("EVAEstimado", f"(NOFTotal + CAPEXOperativo * 4) * (ROICEstimado - {WACC})"),
    ("SemaforoKPI", case(z("DesvioIngresosPct"), [(">=", "0", "CUMPLE"), (">=", "-0.05", "ALERTA")], "CRITICO")),
    ("KPIFueraDeObjetivo", f"CASE WHEN {z('DesvioIngresosPct')} < -0.05 THEN 1 ELSE 0 END"),
    ("VarianzaAbsolutaKPI", "DesvioIngresos"),
    ("RealAnioAnterior", "ing_real_py"),
    ("VariacionYoY", div(f"{z('IngresosReales')} - RealAnioAnterior", "abs(RealAnioAnterior)", "NULL")),
    ("NivelRiesgoCCC", case("CicloConversionEfectivo", [("<=", "65", "[EN PLAN]"), ("<=", "85", "[ALERTA]")],
                            "[CRITICO]", "NULL")),
    ("PrescripcionOperativaCCC", case("CicloConversionEfectivo",
                                      [("<=", "65", "Liquidez y ciclo equilibrado"),
                                       ("<=", "85", "Monitorear stock e inventario")],
                                      "Acelerar cobranzas y diferir pagos", "'Sin datos'")),
    ("RotacionActivosOperativos", div("IngresosReales", "NOFTotal", "NULL")),
    ("NivelRiesgoRotacionActivos", case("RotacionActivosOperativos", [(">=", "1.2", "[ALTA]"), (">=", "0.9", "[MEDIA]")],
                                        "[BAJA]", "NULL")),
    ("PrescripcionRotacionActivos", case("RotacionActivosOperativos",
                                         [(">=", "1.2", "Alta productividad de capital"),
                                          (">=", "0.9", "Rotacion de activos aceptable")],
                                         "Desestibar lotes estancados", "'Sin datos'")),
    ("EfectoDominanteMargen", "CASE WHEN abs(EfectoVolumen) >= abs(EfectoPrecio) AND abs(EfectoVolumen) >= abs(EfectoCosto) "
                              "THEN 'Efecto Volumen (EV)' WHEN abs(EfectoPrecio) >= abs(EfectoVolumen) AND "
                              "abs(EfectoPrecio) >= abs(EfectoCosto) THEN 'Efecto Precio (EP)' ELSE 'Efecto Costo (EC)' END"),
]

BASES = {b for f in FACTS.values() for b in f.aggs} | {"ev", "ep", "ec"}


def _refs(expr: str, names: set) -> set:
    toks = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", re.sub(r"'[^']*'", "", expr)))
    return toks & names


def layers(measures):
    """Group measures so each layer only refers to earlier ones."""
    names = {n for n, _ in measures}
    done, out, pending = set(), [], list(measures)
    while pending:
        layer = [(n, e) for n, e in pending if _refs(e, names) - {n} <= done]
        if not layer:
            raise ValueError(f"cyclic measures: {[n for n, _ in pending]}")
        out.append(layer)
        done |= {n for n, _ in layer}
        pending = [m for m in pending if m[0] not in done]
    return out


def needed_bases(measures) -> set:
    return set().union(*[_refs(e, BASES) for _, e in measures])


def _filter(df: DataFrame, where: dict, dims: set) -> DataFrame:
    for col, vals in where.items():
        if col in dims:
            vals = vals if isinstance(vals, (list, tuple)) else [vals]
            df = df.filter(F.col(col).isin(*vals))
    return df


def _filter_sql(where: dict, dims: set) -> str:
    conds = []
    for col, vals in where.items():
        if col in dims:
            vals = vals if isinstance(vals, (list, tuple)) else [vals]
            conds.append(f"{col} IN (" + ", ".join(repr(v) for v in vals) + ")")
    return (" WHERE " + " AND ".join(conds)) if conds else ""


MONTH_COLUMNS = ["MesDateKey", "AnioMes", "Anio", "Mes"]


def _prior_year(ventas: DataFrame) -> DataFrame:
    """The sales with their months moved one year on, as far as the data go."""
    last = ventas.agg(F.max("MesDateKey")).scalar()
    moved = ventas.withColumns({"MesDateKey": F.col("MesDateKey") + 10000, "Anio": F.col("Anio") + 1,
                                "AnioMes": F.concat((F.col("Anio") + 1).cast("string"), F.substring("AnioMes", 5, 3))})
    return moved.filter(F.col("MesDateKey") <= last)


def _joined(parts: list[tuple[list[str], DataFrame]], by: list[str]) -> DataFrame:
    """Parts with all of ``by`` are full-outer joined; one that lacks some joins
    on those it has, so its value repeats (one row if it has none)."""
    whole = [df for keys, df in parts if keys == by]
    if not whole:
        raise ValueError(f"no fact has the dimensions {by}")
    out = whole[0]
    for df in whole[1:]:
        out = out.join(df, by, "full_outer") if by else out.crossJoin(df)  # one row on either side
    for keys, df in parts:
        if keys != by:
            out = out.join(df, keys, "left") if keys else out.crossJoin(F.broadcast(df))  # df has one row
    return out


def evaluate(spark, d: str, measures, by: list[str], where: dict | None = None, total: bool = False,
             remove: dict[str, list[str]] | None = None, cube: DataFrame | None = None) -> DataFrame:
    """Measures by ``by`` under the slicers ``where``.  ``remove``: base sum ->
    columns whose slicers and grouping it ignores."""
    where, remove = where or {}, remove or {}
    need = needed_bases(measures)
    parts: list[tuple[list[str], DataFrame]] = []
    built: dict[str, DataFrame] = {"V": cube} if cube is not None else {}

    def src_of(key):
        # each fact is planned once per evaluation: branches share one plan
        # (and the budget's materialised cells)
        if key not in built:
            # the budget, a row per month, line and cost centre, is written once for its branches
            built[key] = (materialise(_presupuesto(spark, d, src_of("V"))) if key == "P" else _prior_year(src_of("V")) if key == "Y"
                          else FACTS[key].builder(spark, d))
        return built[key]

    for key, f in FACTS.items():
        wanted: dict[tuple, list[str]] = {}
        for b in f.aggs:
            if b in need:
                wanted.setdefault(tuple(remove.get(b, ())), []).append(b)
        for gone, cols in wanted.items():
            keys = [c for c in by if c in f.dims and c not in gone]
            src = _filter(src_of(key), {c: v for c, v in where.items() if c not in gone}, f.dims)
            parts.append((keys, src.groupBy(*keys).agg(*[F.expr(f.aggs[c]).cast("double").alias(c) for c in cols])))
    if need & {"ev", "ep", "ec"}:
        keys = [c for c in by if c in FACTS["P"].dims]
        parts.append((keys, _variance_terms(src_of("V"), src_of("P"), keys, where)))
    own = [p for p in parts if "ing_real_py" not in p[1].columns]
    prior = [p for p in parts if "ing_real_py" in p[1].columns]
    out = _joined(own or prior, by)
    for keys, df in prior if own else []:  # only where the current context has a row
        out = out.join(df, keys, "left") if keys else out.crossJoin(F.broadcast(df))
    for layer in layers(measures):
        out = out.withColumns({n: F.expr(e) for n, e in layer})
    out = out.select(*by, *[n for n, _ in measures])
    if total and by:
        types = dict(out.dtypes)
        whole = evaluate(spark, d, measures, [], where, remove=remove, cube=built.get("V"))
        out = out.unionByName(whole.select(*[F.lit(None).cast(types[c]).alias(c) for c in by], *whole.columns))
    return out


def _variance_terms(ventas, budget, by, where):
    """SUMX over products of the volume/price/cost effects."""
    v = _filter(ventas, where, FACTS["V"].dims)
    p = _filter(budget, where, FACTS["P"].dims)
    k = by + ["Linea"] if "Linea" not in by else by
    va = v.groupBy(*k).agg(F.sum("VolumenReal").cast("double").alias("qr"),
                           F.sum("IngresosReales").cast("double").alias("rr"),
                           F.sum("CostoReal").cast("double").alias("cr"))
    pa = p.groupBy(*k).agg(F.sum("VolumenPresupuestado").cast("double").alias("qp"),
                           F.sum("IngresosPresupuestados").cast("double").alias("rp"),
                           F.sum("CostoPresupuestado").cast("double").alias("cp"))
    j = va.join(pa, k, "full_outer")
    j = j.withColumns({
        "_pp": F.expr(div("rp", "qp")), "_cpl": F.expr(div("cp", "qp")),
        "_pr": F.expr(div("rr", "qr")), "_crl": F.expr(div("cr", "qr")),
        "_qr": F.expr(z("qr")), "_qp": F.expr(z("qp"))})
    return j.groupBy(*by).agg(
        F.sum(F.expr("(_qr - _qp) * (_pp - _cpl)")).alias("ev"),
        F.sum(F.expr("_qr * (_pr - _pp)")).alias("ep"),
        F.sum(F.expr("_qr * (_cpl - _crl)")).alias("ec"))


def evaluate_sql(measures, by: list[str], where: dict | None = None, total: bool = False,
                 remove: dict[str, list[str]] | None = None) -> str:
    """Oracle.  For each context row and base sum a scalar subquery over the fact's
    own rows that agree with the row and the slicers, as a filter context is
    defined; the measures' formulas, being data, are the same."""
    where, remove = where or {}, remove or {}
    need = needed_bases(measures)
    facts = {k: f for k, f in FACTS.items() if set(f.aggs) & need}
    ctes: list[str] = []
    for k in [*facts, *(["V", "P"] if need & {"ev", "ep", "ec"} else [])]:
        ctes += [c for c in FACTS[k].sql_ctes if c not in ctes]
    spines = [f"SELECT DISTINCT {', '.join(by)} FROM {f.table}{_filter_sql(where, f.dims)}"
              for k, f in facts.items() if k != "Y" and set(by) <= f.dims and any(not remove.get(b) for b in f.aggs if b in need)] if by else ["SELECT 1"]
    if not spines:
        spines = [f"SELECT DISTINCT {', '.join(by)} FROM ventas{_filter_sql(where, FACTS['V'].dims)}"]
    ctes.append(f"ctx({', '.join(by) or 'uno'}) AS ({' UNION '.join(spines)})")
    for k, f in facts.items():
        for gone in {tuple(remove.get(b, ())) for b in f.aggs if b in need}:
            keys = [c for c in by if c in f.dims and c not in gone]
            cols = [b for b in f.aggs if b in need and tuple(remove.get(b, ())) == gone]
            name = f"base_{k}_{len(gone)}"
            sums = ", ".join(f"CAST({f.aggs[c]} AS DOUBLE) AS {c}" for c in cols)
            inner = f"SELECT * FROM {f.table}{_filter_sql({c: v for c, v in where.items() if c not in gone}, f.dims)}"
            ctes.append(f"{name} AS (SELECT {''.join(c + ', ' for c in keys)}{sums} FROM ({inner}) z{' GROUP BY ' + ', '.join(keys) if keys else ''})")
            ctes.append(f"j{name} AS (SELECT {', '.join(['x.' + c for c in by] or ['uno'])}, {', '.join('y.' + c for c in cols)} FROM ctx x LEFT JOIN {name} y ON "
                        + (" AND ".join(f"x.{c} = y.{c}" for c in keys) or "true") + ")")
    joins = [c.split(" AS ", 1)[0] for c in ctes if c.startswith("jbase_")]
    if need & {"ev", "ep", "ec"}:
        keys = [c for c in by if c in FACTS["P"].dims]
        k = [*keys, "Linea"] if "Linea" not in keys else keys
        kk = ", ".join(k)
        rows = [f"SELECT {kk}, VolumenReal AS qr, IngresosReales AS rr, CostoReal AS cr, NULL AS qp, NULL AS rp, NULL AS cp FROM ventas{_filter_sql(where, FACTS['V'].dims)}",
                f"SELECT {kk}, NULL, NULL, NULL, VolumenPresupuestado, IngresosPresupuestados, CostoPresupuestado FROM presupuesto_l{_filter_sql(where, FACTS['P'].dims)}"]
        sums = ", ".join(f"CAST(SUM({c}) AS DOUBLE) AS {c}" for c in ("qr", "rr", "cr", "qp", "rp", "cp"))
        unit = lambda a, q: f"(CASE WHEN COALESCE({q}, 0) = 0 THEN 0.0 ELSE {a} / {q} END)"
        ctes.append(f"lines AS (SELECT {kk}, {sums} FROM ({' UNION ALL '.join(rows)}) u GROUP BY {kk})")
        ctes.append("effects AS (SELECT " + "".join(c + ", " for c in keys) +
                    f"SUM((COALESCE(qr, 0) - COALESCE(qp, 0)) * ({unit('rp', 'qp')} - {unit('cp', 'qp')})) AS ev, "
                    f"SUM(COALESCE(qr, 0) * ({unit('rr', 'qr')} - {unit('rp', 'qp')})) AS ep, SUM(COALESCE(qr, 0) * ({unit('cp', 'qp')} - {unit('cr', 'qr')})) AS ec "
                    f"FROM lines{' GROUP BY ' + ', '.join(keys) if keys else ''})")
        ctes.append(f"jeffects AS (SELECT {', '.join(['x.' + c for c in by] or ['uno'])}, ev, ep, ec FROM ctx x LEFT JOIN effects y ON "
                    + (" AND ".join(f"x.{c} = y.{c}" for c in keys) or "true") + ")")
        joins.append("jeffects")
    body = "SELECT * FROM ctx" + "".join(f" JOIN {j} USING ({', '.join(by) or 'uno'})" for j in joins)
    for i, layer in enumerate(layers(measures)):
        body = "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in layer) + f" FROM ({body}) l{i}"
    sql = "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(by + [n for n, _ in measures])} FROM ({body}) fin"
    if not (total and by):
        return sql
    whole = evaluate_sql(measures, [], where, remove=remove)
    return f"SELECT * FROM ({sql}) r UNION ALL SELECT {', '.join(['NULL'] * len(by) + [n for n, _ in measures])} FROM ({whole}) t"
