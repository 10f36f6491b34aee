"""Month keys (``yyyymm``) and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(c: Column) -> Column:
    return F.year(c) * 100 + F.month(c)


def key_to_month(key: Column) -> Column:
    """First day of the month a ``yyyymm`` key stands for."""
    return F.make_date(F.call_function("div", key, F.lit(100)).cast("int"), key % 100, F.lit(1))


def month_number(key: Column) -> Column:
    """Months since year 0 of a ``yyyymm`` key: neighbours differ by one."""
    return F.call_function("div", key, F.lit(100)).cast("int") * 12 + key % 100


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def hours_between(a: Column, b: Column) -> Column:
    """Whole hours from ``a`` to ``b``, truncated.

    Interval arithmetic on zone-less timestamps, so no time zone takes part.
    """
    return F.call_function("div", b - a, F.expr("INTERVAL '1' HOUR"))
