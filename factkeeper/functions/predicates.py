"""Row predicates (P1-P7) written so Catalyst can push them into the scan.

Bounds are cast to the column's own type up front, so a date window on a
``timestamp_ntz`` column stays a plain range comparison on the column
(``PushedFilters: GreaterThanOrEqual/LessThan``) instead of a function of the
column that parquet cannot use.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factkeeper.functions.time_windows import year_window

# The twelve activity columns of the daily fact; a row is
# "active" if any of them is above zero (NULL counts as zero).
ACTIVITY_COLUMNS = [
    "deposit_cases", "deposit_amount", "withdraw_cases", "withdraw_amount",
    "bonus", "add_transaction", "deduct_transaction", "add_bonus", "deduct_bonus",
    "total_bet", "total_bet_amount", "total_valid_bet_amount",
]


def typed_lit(value, dtype) -> Column:
    """A literal of the column's type (folded at plan time).

    Dates and datetimes go through their text form: a ``timestamp_ntz`` keeps
    the wall-clock value as written, a ``timestamp`` reads it in the session
    time zone — never in the Python process's local zone."""
    if isinstance(value, (date, datetime)):
        return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime)
                     else value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def _dtype(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def in_window(df: DataFrame, col: str, start, end) -> Column:
    """``start <= col < end``; NULL never matches (result NULL)."""
    t = _dtype(df, col)
    c = F.col(col)
    return (c >= typed_lit(start, t)) & (c < typed_lit(end, t))


def in_values(col: str, values) -> Column:
    """``col IN (values)``; NULL never matches."""
    return F.col(col).isin(list(values))


def is_active(cols=ACTIVITY_COLUMNS) -> Column:
    """Any column above zero, NULL taken as zero; never NULL itself."""
    return reduce(or_, [F.coalesce(F.col(c), F.lit(0)) > 0 for c in cols])


def on_dates(df: DataFrame, col: str, days) -> Column:
    """P5: the row's day is one of ``days``.

    On a date column this is ``IN``; on a timestamp column it is an OR of
    one-day ranges, which parquet can push, unlike ``cast(ts as date) IN``.
    """
    t = _dtype(df, col)
    days = sorted(set(days))
    if isinstance(t, T.DateType):
        return F.col(col).isin([typed_lit(d, t) for d in days])
    return reduce(or_, [in_window(df, col, lo, hi) for lo, hi in day_runs(days)])


def day_runs(days) -> list[tuple[date, date]]:
    """Consecutive days merged into half-open ranges: [1,2,3,5] → [1,4), [5,6)."""
    runs: list[list[date]] = []
    for d in sorted(set(days)):
        if runs and runs[-1][1] == d:
            runs[-1][1] = d + timedelta(days=1)
        else:
            runs.append([d, d + timedelta(days=1)])
    return [(lo, hi) for lo, hi in runs]


def year_is(df: DataFrame, col: str, year: int) -> Column:
    """The row belongs to ``year``.

    Date/timestamp columns become a range (pushable); integer columns an
    equality; text years are parsed, and text that is no number raises, like a cast.
    """
    t = _dtype(df, col)
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        lo, hi = year_window(year)
        return in_window(df, col, lo, hi)
    if isinstance(t, (T.IntegralType, T.DecimalType, T.FractionalType)):
        return F.col(col).cast("int") == F.lit(year)
    return _text_year(col) == F.lit(year)


def year_of(df: DataFrame, col: str) -> Column:
    """the year of a row as INT, whatever the column type."""
    t = _dtype(df, col)
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.year(F.col(col)).cast("int")
    if isinstance(t, (T.IntegralType, T.DecimalType, T.FractionalType)):
        return F.col(col).cast("int")
    return _text_year(col)


def _text_year(col: str) -> Column:
    """A text year as INT; NULL stays NULL, other text raises whatever the ANSI setting."""
    c = F.col(col)
    bad = F.raise_error(F.concat(F.lit(f"{col} is not a year: "), c)).cast("int")
    return F.coalesce(c.try_cast("int"), F.when(c.isNotNull(), bad))


def not_true(pred: Column) -> Column:
    """Complement that keeps rows where ``pred`` is NULL (SQL DELETE keeps them)."""
    return ~F.coalesce(pred, F.lit(False))
