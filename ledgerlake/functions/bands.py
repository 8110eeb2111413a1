"""Threshold bands (traffic lights and prescriptions) as generated CASE chains.

``band(value, rules, default, on_null)`` turns an ordered rule table into one
``when`` chain; every traffic-light measure is one rule table below.
Comparison direction and boundary inclusion follow the source exactly.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "==": operator.eq, "!=": operator.ne}


def band(value, rules, default=None, on_null=None, null_blank: bool = True) -> Column:
    """value -> label by the first matching (op, threshold, label) rule.

    ``on_null``: label for a null value when ``null_blank`` (ISBLANK tested
    first).  When ``null_blank`` is False a null compares like 0 (DAX blank
    semantics in a SWITCH(TRUE()) without ISBLANK)."""
    v = F.col(value) if isinstance(value, str) else value
    if not null_blank:
        v = F.coalesce(v, F.lit(0))
    expr = None
    for op, thr, label in rules:
        cond = _OPS[op](v, thr if isinstance(thr, Column) else F.lit(thr))
        lab = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    dflt = default if isinstance(default, Column) else F.lit(default)
    expr = dflt if expr is None else expr.otherwise(dflt)
    if null_blank:
        nl = on_null if isinstance(on_null, Column) else F.lit(on_null)
        expr = F.when(v.isNull(), nl.cast("string")).otherwise(expr)
    return expr


def band_sql(value: str, rules, default, on_null=None, null_blank: bool = True) -> str:
    """The same rule table as SQL text (used by oracles and docs)."""
    v = value if null_blank else f"COALESCE({value}, 0)"
    parts = []
    if null_blank:
        parts.append(f"WHEN {value} IS NULL THEN {_lit(on_null)}")
    for op, thr, label in rules:
        sop = "=" if op == "==" else ("<>" if op == "!=" else op)
        parts.append(f"WHEN {v} {sop} {thr} THEN {_lit(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {_lit(default)} END"


def _lit(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    return repr(x)


# ---------------------------------------------------------------------------
# Thresholds and labels that must equal the source's output.
# ---------------------------------------------------------------------------

PARETO_SQL_RULES = [("<=", 80.0, "Clase A (Top 80%)"), ("<=", 95.0, "Clase B (80%-95%)")]
PARETO_SQL_DEFAULT = "Clase C (Cola 95%-100%)"

ABC_RULES = [("<=", 0.75, "Clase A"), ("<=", 0.92, "Clase B")]
ABC_DEFAULT = "Clase C"

ABC_ADVICE = {
    "Clase A": "Prioridad: Proteger stock y margen",
    "Clase B": "Estrategia: Estimular volumen Horeca",
    "Clase C": "Accion: Ajustar precio o descontinuar",
}
ABC_ADVICE_DEFAULT = "Revision de cartera"

EXTRACTION_SQL_RULES = [(">=", 72.0, "Alta Eficiencia Enologica"),
                        (">=", 69.0, "Rendimiento Estandar Bodega")]
EXTRACTION_SQL_DEFAULT = "Baja Extraccion / Alerta Operativa"

OPEX_ALERT_RULES = [(">", 0.05, "[CRITICO]"), (">", 0.0, "[ALERTA]")]
OPEX_ALERT_DEFAULT = "[EN PLAN]"

KPI_STATUS_RULES = [(">=", 0.0, "CUMPLE"), (">=", -0.05, "ALERTA")]
KPI_STATUS_DEFAULT = "CRITICO"

ASSET_TURNOVER_RULES = [(">=", 1.2, "[ALTA]"), (">=", 0.9, "[MEDIA]")]
ASSET_TURNOVER_DEFAULT = "[BAJA]"
