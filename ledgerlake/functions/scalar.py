"""Scalar Column functions: safe division, rounding helpers, math and text.

All are built-in expressions (codegen, no Python per row).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def divide(a, b, alt=None) -> Column:
    """DIVIDE(a, b[, alt]): ``alt`` (default null/BLANK) when b is 0 or null."""
    a, b = col(a), col(b)
    alt_c = F.lit(None).cast("double") if alt is None else (alt if isinstance(alt, Column) else F.lit(alt))
    return F.when(b.isNull() | (b == 0), alt_c).otherwise(a.cast("double") / b.cast("double"))


def safe_ratio(a, b, digits: int | None = None) -> Column:
    """round(a/b, n) when b > 0, else 0.0 (the ETL's guarded ratio)."""
    a, b = col(a), col(b)
    r = a.cast("double") / b.cast("double")
    if digits is not None:
        r = F.round(r, digits)
    return F.when(b > 0, r).otherwise(F.lit(0.0))


def dbl(c) -> Column:
    return col(c).cast("double")


def coalesce_zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def money_round(c, digits: int = 2) -> Column:
    """Round an exact decimal amount and hand it out as double."""
    return F.round(col(c), digits).cast("double")


def norm_cdf(x) -> Column:
    """Standard normal CDF as a Column expression.

    Spark has no ``erf``; this is the Abramowitz-Stegun 7.1.26 rational
    approximation of erf (|error| < 1.5e-7), evaluated JVM-side.
    """
    x = col(x).cast("double")
    z = F.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * F.exp(-z * z)
    return F.when(x >= 0, 0.5 * (1.0 + erf)).otherwise(0.5 * (1.0 - erf))


def pct_text(c, digits: int = 1) -> Column:
    """FORMAT(x, "0.0%")-style text."""
    return F.concat(F.format_number(col(c) * 100.0, digits), F.lit("%"))
