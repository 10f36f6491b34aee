from .aggregates import avg_if, by_segment, measure_totals, profile_delta, sum_if
from .dedupe import latest_per_key
from .intervals import active_by_month
from .keys import (
    extend_surrogate_key,
    lookup_key,
    ntile_scalable,
    with_position,
    with_surrogate_key,
)
from .windows import delta_calendar, delta_prev, lead_over_next, rank_desc, running_count, with_streak

__all__ = [
    "active_by_month",
    "avg_if",
    "by_segment",
    "delta_calendar",
    "delta_prev",
    "extend_surrogate_key",
    "latest_per_key",
    "lead_over_next",
    "lookup_key",
    "measure_totals",
    "ntile_scalable",
    "profile_delta",
    "rank_desc",
    "running_count",
    "sum_if",
    "with_position",
    "with_streak",
    "with_surrogate_key",
]
