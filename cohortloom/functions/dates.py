"""Day arithmetic on ``yyyyMMdd`` text; dates inside, text only at the edges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(text: Column) -> Column:
    return F.to_date(text, "yyyyMMdd")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def shift(day: Column, days: int = 0, months: int = 0, years: int = 0) -> Column:
    return F.date_add(F.add_months(day, months + 12 * years), days)


def last_week(day: Column) -> Column:
    """The seven days, Monday first, of the week before the one holding ``day``."""
    monday = F.date_sub(F.trunc(day, "week"), 7)
    return F.sequence(monday, F.date_add(monday, 6))


def last_month(day: Column) -> Column:
    """Every day of the month before the one holding ``day``."""
    first = F.add_months(F.trunc(day, "month"), -1)
    return F.sequence(first, F.last_day(first))


def period_end(day: Column, period: str) -> Column:
    """Last day of the last complete ``day``/``week``/``month``/``year`` before ``day``."""
    if period == "day":
        return F.date_sub(day, 1)
    return F.date_sub(F.trunc(day, period), 1)


def epoch_to_day_text(seconds: Column) -> Column:
    """Epoch seconds to a UTC ``yyyyMMdd`` day, whatever the session time zone."""
    return day_text(F.date_add(F.lit(date(1970, 1, 1)), F.floor(seconds / 86400).cast("int")))


def day_text_to_epoch(text: Column) -> Column:
    return F.datediff(day_of(text), F.lit(date(1970, 1, 1))).cast("long") * 86400


def clamp_days(start: date, end: date, last: date) -> tuple[date, date]:
    """``[start, end]`` clipped to [first day of ``last``'s month one year before, end of ``last``'s month];
    an interval outside comes out with its end before its start."""
    lowest = date(last.year - 1, last.month, 1)
    next_month = date(last.year + last.month // 12, last.month % 12 + 1, 1)
    return max(start, lowest), min(end, next_month - timedelta(days=1))


def clamp_interval(start: str, end: str, last_day: str) -> tuple[str, str]:
    """:func:`clamp_days` with ``yyyyMMdd`` in and out."""
    days = [datetime.strptime(d, "%Y%m%d").date() for d in (start, end, last_day)]
    low, high = clamp_days(*days)
    return low.strftime("%Y%m%d"), high.strftime("%Y%m%d")
