"""YYYYMMDD integers, months and day arithmetic."""

from __future__ import annotations

import calendar
import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(c: Column, by: int) -> Column:
    return F.call_function("div", c, F.lit(by)).cast("int")


def int_to_date(c: ColumnOrName) -> Column:
    """YYYYMMDD integer to date, by integer arithmetic; an impossible date raises."""
    c = _col(c).cast("int")
    return F.make_date(_div(c, 10000), _div(c, 100) % 100, c % 100)


def try_int_to_date(c: ColumnOrName) -> Column:
    """As :func:`int_to_date`, but NULL for an impossible date (profiling only)."""
    return F.try_to_date(_col(c).cast("string"), "yyyyMMdd")


def int_prefix(c: ColumnOrName, digits: int) -> Column:
    """Leading digits of a YYYYMMDD integer: 4 for the year, 6 for the month."""
    return F.substring(_col(c).cast("string"), 1, digits)


def month_of(c: ColumnOrName) -> Column:
    """Date to 'YYYY-MM'."""
    return F.date_format(_col(c), "yyyy-MM")


def as_date(value: date | datetime | str) -> date:
    """Accept a date, a timestamp or an ISO string."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(str(value)[:10])


def as_int(value: date | datetime | str) -> int:
    d = as_date(value)
    return d.year * 10000 + d.month * 100 + d.day


def shift_int(value: int, days: int) -> int:
    """Move a YYYYMMDD integer by calendar days (driver side, for scan bounds)."""
    return as_int(datetime.strptime(str(value), "%Y%m%d").date() + timedelta(days=days))


def check_days(**days: int) -> None:
    for name, value in days.items():
        if value <= 0:
            raise ValueError(f"{name} must be positive, got {value}")


def check_month(month: str) -> str:
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"month must be 'YYYY-MM', got {month!r}")
    return month


def month_bounds(month: str) -> tuple[int, int]:
    """First and last day of a 'YYYY-MM' month as YYYYMMDD integers."""
    year, mon = (int(p) for p in check_month(month).split("-"))
    last = calendar.monthrange(year, mon)[1]
    return year * 10000 + mon * 100 + 1, year * 10000 + mon * 100 + last
