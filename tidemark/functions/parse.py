"""Text to typed values. Text that does not parse becomes NULL, never an error;
the quality rules then report it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

_UINT = r"^[0-9]+$"
_ISO_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_ISO_DATETIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def parse_dmy(c: Column) -> Column:
    """Day/month/year, one or two digits for day and month."""
    return F.try_to_date(blank_to_null(c), "d/M/yyyy")


def parse_iso_date(c: Column) -> Column:
    """Year-month-day. The cast reads it about twice as fast as a date pattern would;
    the guard turns away what only the cast accepts."""
    text = blank_to_null(c)
    return F.when(text.rlike(_ISO_DATE), text.try_cast("date"))


def parse_iso_datetime(c: Column) -> Column:
    """Zone-less date and time; independent of the session time zone."""
    text = blank_to_null(c)
    return F.when(text.rlike(_ISO_DATETIME), text.try_cast("timestamp_ntz"))


def parse_uint(c: Column, default: int | None = None) -> Column:
    """Unsigned integer. Blank takes the default; text that is no number is NULL."""
    text = blank_to_null(c)
    number = F.when(text.rlike(_UINT), text.try_cast("int"))
    return number if default is None else F.when(text.isNull(), F.lit(default)).otherwise(number)


def parse_decimal(c: Column, precision: int, scale: int, default: str | None = None) -> Column:
    """Decimal. Blank takes the default; text that is no number is NULL."""
    kind = f"decimal({precision},{scale})"
    text = blank_to_null(c)
    number = text.try_cast(kind)
    if default is None:
        return number
    return F.when(text.isNull(), F.lit(default).cast(kind)).otherwise(number)


def parse_rounded_uint(c: Column) -> Column:
    """Decimal text such as ``4.5`` to the nearest integer, halves away from zero."""
    return F.round(blank_to_null(c).try_cast("decimal(3,1)"), 0).cast("int")


def parse_flag(c: Column) -> Column:
    """True for the word "true" in any case; a missing text stays NULL."""
    return F.lower(F.trim(c)) == "true"
