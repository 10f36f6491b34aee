from .numeric import from_hundredths, hundredths, pct, round_ratio, safe_ratio
from .parse import (
    parse_decimal,
    parse_dmy,
    parse_flag,
    parse_iso_date,
    parse_iso_datetime,
    parse_rounded_uint,
    parse_uint,
)
from .text import blank_to_null, canonicalize, fold
from .timekeys import hours_between, key_to_month, month_end, month_key, month_number, month_start

__all__ = [
    "blank_to_null",
    "canonicalize",
    "fold",
    "from_hundredths",
    "hours_between",
    "hundredths",
    "key_to_month",
    "month_end",
    "month_key",
    "month_number",
    "month_start",
    "parse_decimal",
    "parse_dmy",
    "parse_flag",
    "parse_iso_date",
    "parse_iso_datetime",
    "parse_rounded_uint",
    "parse_uint",
    "pct",
    "round_ratio",
    "safe_ratio",
]
