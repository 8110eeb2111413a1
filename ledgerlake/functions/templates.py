"""Texts of measures as templates: branches on conditions, placeholders with number formats.

A text is data; it compiles to one Spark Column and to the same DuckDB SQL.  Conditions are
SQL that both read.  A placeholder is ``{column}`` or ``{column:format}``; a null value leaves its
place empty, as joining a blank to a text does.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Text:
    """(condition, template) in order; a condition None always holds.  Where none holds the text is null."""
    branches: tuple[tuple[str | None, str], ...]


def text(*branches: tuple[str | None, str]) -> Text:
    return Text(tuple(branches))


def _printf(pattern: str, value: str, dialect: str) -> str:
    return f"{'format_string' if dialect == 'spark' else 'printf'}('{pattern}', {value})"


def _grouped(value: str, digits: int, dialect: str) -> str:
    """Digits in groups of three."""
    value = _rounded(value, digits)
    return f"format_number({value}, {digits})" if dialect == "spark" else f"format('{{:,.{digits}f}}', {value})"


def _rounded(value: str, digits: int) -> str:
    return f"(round(CAST({value} AS DOUBLE), {digits}) + 0.0)"  # no minus before zero


def _millions(value: str, dialect: str) -> str:
    return f"concat('$', {_grouped(f'abs({value}) / 1000000', 1, dialect)}, ' M')"


FORMATS = {
    "": lambda x, k: f"CAST({x} AS {'STRING' if k == 'spark' else 'VARCHAR'})",
    "pct1": lambda x, k: _printf("%.1f%%", _rounded(f"({x}) * 100", 1), k),
    "dec2": lambda x, k: _printf("%.2f", _rounded(x, 2), k),
    "dec3": lambda x, k: _printf("%.3f", _rounded(x, 3), k),
    "dec4": lambda x, k: _printf("%.4f", _rounded(x, 4), k),
    "int": lambda x, k: _grouped(x, 0, k),
    "money": lambda x, k: f"concat('$', {_grouped(x, 0, k)})",
    "millions": _millions,
    "change": lambda x, k: f"concat(CASE WHEN round(({x}) / 1000000, 1) > 0 THEN '+' WHEN round(({x}) / 1000000, 1) < 0 THEN '-' ELSE '' END, {_millions(x, k)})",
}


def compiled(t: Text, dialect: str) -> str:
    """SQL of the text for ``spark`` or ``duckdb``."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''" if dialect != "spark" else "\\'") + "'"

    def template(s: str) -> str:
        parts = []
        for literal, name, form in re.findall(r"([^{]*)(?:\{(\w+)(?::(\w+))?\})?", s):
            if literal:
                parts.append(quoted(literal))
            if name:
                parts.append(f"CASE WHEN {name} IS NULL THEN '' ELSE {FORMATS[form](name, dialect)} END")
        return f"concat({', '.join(parts)})" if parts else "''"

    arms = "".join(f" WHEN {c} THEN {template(s)}" for c, s in t.branches if c is not None)
    last = next((template(s) for c, s in t.branches if c is None), None)
    if not arms:
        return last or "NULL"
    return f"CASE{arms}" + (f" ELSE {last}" if last else "") + " END"


def column(t: Text) -> Column:
    return F.expr(compiled(t, "spark"))
