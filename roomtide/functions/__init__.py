from roomtide.functions.dates import (
    advance_days,
    as_compact,
    as_dashed,
    days_between,
    parse_day,
    share_of_days,
    week_bucket,
)
from roomtide.functions.numbers import equal_width_band, packed_pair

__all__ = [
    "advance_days", "as_compact", "as_dashed", "days_between", "parse_day", "share_of_days",
    "week_bucket", "equal_width_band", "packed_pair",
]
