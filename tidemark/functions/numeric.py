"""Ratios that are safe on a zero denominator and exact in their last digit.

Operands are column names or SQL expressions: the formulas use each operand
several times, and one parsed text builds far faster than a tree of calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(a: str, b: str) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(F.expr(a), F.expr(b))


def round_ratio(a: str, b: str, digits: int, scale: int = 0) -> Column:
    """a / b to ``digits`` (at most 4) decimals, halves away from zero; NULL where b is zero.

    Works on whole numbers, so no intermediate rounding can move the last
    digit. ``scale`` is the number of decimals a and b carry; both are lifted
    to whole numbers by it.
    """
    num, den = _whole(a, scale), _whole(b, scale)
    units = f"(abs({num}) * {2 * 10**digits} + abs({den})) div nullif(abs({den}) * 2, 0)"
    sign = f"if(({num} < 0) != ({den} < 0), -1, 1)"
    return F.expr(f"cast(cast({units} AS decimal(20,0)) * {sign} * {10**-digits:.{digits}f} AS decimal(20,{digits}))")


def _whole(e: str, scale: int) -> str:
    if scale:
        e = f"cast({e} AS decimal(28,{scale})) * {10**scale}"
    return f"cast({e} AS decimal(30,0))"


def pct(a: str, b: str, digits: int = 2) -> Column:
    """a as a percentage of b; both whole numbers or money."""
    return round_ratio(f"100 * cast({a} AS decimal(26,2))", b, digits, scale=2)


def hundredths(name: str) -> Column:
    """A number with at most two decimals as a whole number of hundredths.

    Sums of these stay in 64-bit arithmetic; a sum of DECIMAL(12,2) itself needs
    more digits than that and costs Spark two to three times as much per row.
    """
    return F.expr(f"cast({name} * 100L AS bigint)")


def from_hundredths(name: str) -> Column:
    return F.expr(f"cast(cast({name} AS decimal(20,0)) * 0.01 AS decimal(22,2))")
