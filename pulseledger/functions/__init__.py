from .columns import (
    calendar_days_between,
    date_spine,
    day_literal,
    each_day,
    flag,
    instant,
    minute_diff,
    minute_start,
    month_of,
    name,
    optional_col,
    round_half_up,
    safe_ratio,
    second_diff,
    surrogate_key,
    text_literal,
)
from .frames import aggregate, union_all
from .health import health_score, health_segment, lifecycle_status

__all__ = [
    "aggregate",
    "calendar_days_between",
    "date_spine",
    "day_literal",
    "each_day",
    "flag",
    "health_score",
    "health_segment",
    "instant",
    "lifecycle_status",
    "minute_diff",
    "minute_start",
    "month_of",
    "name",
    "optional_col",
    "round_half_up",
    "safe_ratio",
    "second_diff",
    "surrogate_key",
    "text_literal",
    "union_all",
]
