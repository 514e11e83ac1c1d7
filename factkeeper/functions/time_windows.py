"""Half-open date windows relative to an explicit ``as_of`` day.

The jobs never read the wall clock: the caller passes ``as_of`` (the day the
run stands on, i.e. "today"), so a rerun gives the same window.
All windows are ``[start, end)``.
"""

from __future__ import annotations

from datetime import date, timedelta


def recent_days(as_of: date, days_back: int) -> tuple[date, date]:
    """Last ``days_back`` full days before ``as_of``: ``[as_of-N, as_of)``."""
    return as_of - timedelta(days=days_back), as_of


def yesterday_today(as_of: date) -> tuple[date, date]:
    """Yesterday and today: ``[as_of-1, as_of+1)``."""
    return as_of - timedelta(days=1), as_of + timedelta(days=1)


def h_minus_1(as_of: date) -> tuple[date, date]:
    """Only yesterday: ``[as_of-1, as_of)``."""
    return recent_days(as_of, 1)


def first_of_next_month(d: date) -> date:
    """First day of the month after ``d`` (December rolls to January)."""
    if d.month == 12:
        return date(d.year + 1, 1, 1)
    return date(d.year, d.month + 1, 1)


def month_window(as_of: date) -> tuple[date, date]:
    """Calendar month containing ``as_of``."""
    start = as_of.replace(day=1)
    return start, first_of_next_month(start)


def month_of(text: str) -> tuple[date, date]:
    """Window of a ``YYYY-MM`` text."""
    y, m = text.split("-")
    return month_window(date(int(y), int(m), 1))


def year_window(year: int) -> tuple[date, date]:
    return date(year, 1, 1), date(year + 1, 1, 1)


def two_days_back(as_of: date) -> list[date]:
    """The staging→serving copy's day set ``{as_of-2, as_of-1}``."""
    return [as_of - timedelta(days=2), as_of - timedelta(days=1)]


def yesterday_and_today(as_of: date) -> list[date]:
    """The hourly copy's day set ``{as_of-1, as_of}``."""
    return [as_of - timedelta(days=1), as_of]


def days_in(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days)]
