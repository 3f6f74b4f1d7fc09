"""Exact decimal arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """SQL ``a DIV b``: exact integral quotient (truncated), bigint result."""
    return F.call_function("div", a, b)


def ratio_half_up(num: Column, den: Column, scale: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0), scale)`` with one exact rounding step.

    ``round(avg(decimal))`` would round twice (the average is first cut to a
    fixed scale), so a true mean just below a half cent could round up.
    Here the quotient is rounded half away from zero on exact integers:
    ``sign(n) * ((2*|n| + d) DIV (2*d))`` with ``n`` in units of 10^-scale.
    """
    factor = F.lit(10 ** scale)
    n = num * factor
    d = F.nullif(den, F.lit(0))
    units = idiv(F.abs(n) * 2 + d, d * 2) * F.signum(n).cast("bigint")
    return (units.cast("decimal(38,0)") / factor).cast(f"decimal(38,{scale})")


def half_up(c: Column, scale: int = 2) -> Column:
    """Round half away from zero (SQL ``ROUND``), not banker's rounding."""
    return F.round(c, scale)
