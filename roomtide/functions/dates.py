"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import col

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return col(x) if isinstance(x, str) else x


def parse_day(text: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` or ``yyyyMMdd`` text to a date."""
    return F.to_date(F.replace(_c(text), F.lit("-"), F.lit("")), "yyyyMMdd")


def as_dashed(day: ColumnOrName) -> Column:
    return F.date_format(_c(day), "yyyy-MM-dd")


def as_compact(day: ColumnOrName) -> Column:
    """``yyyyMMdd`` as an integer."""
    return F.date_format(_c(day), "yyyyMMdd").cast("int")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(_c(end), _c(start))


def advance_days(live_dt: ColumnOrName, event_dt: ColumnOrName) -> Column:
    """Days from an order or cancel event to the stay; negative if it came after."""
    return F.datediff(_c(live_dt), _c(event_dt))


def week_bucket(day: ColumnOrName, weeks: int) -> Column:
    """ISO week number divided by the bucket width, whole part."""
    return F.floor(F.weekofyear(_c(day)) / F.lit(weeks)).cast("int")


def share_of_days(days: Column, ratio: float) -> Column:
    """Whole part, towards zero, of a share of a number of days."""
    return (days * F.lit(float(ratio))).cast("int")
