"""Dates: coded integers, dates in the future, month bounds."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates arrive as integers of eight digits, such as 20240131.
SMALLEST, LARGEST = 10_000_000, 99_999_999


def coded_date(number: Column) -> Column:
    """Date of a ``yyyymmdd`` integer; NULL if it has not eight digits or names no day.

    Plain arithmetic: for a table of sales this is the dearest rule, and parsing text takes several times as long.
    """
    year = F.call_function("div", number, F.lit(10_000)).cast("int")
    month = F.call_function("div", number % 10_000, F.lit(100)).cast("int")
    day = number % 100
    date = F.date_add(F.make_date(year, month, F.lit(1)), day - 1)
    in_range = number.between(SMALLEST, LARGEST) & month.between(1, 12) & day.between(1, 31)
    return F.when(in_range, F.when(F.month(date) == month, date))


def not_after(date: Column, as_of: Column | dt.date | None = None) -> Column:
    """The date, or NULL if it lies after ``as_of`` (today if not given)."""
    limit = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.when(date > limit, None).otherwise(date)


def in_months(start: dt.date, end: dt.date, year: str = "year", month: str = "month") -> Column:
    """Condition on the partition columns met by every day of ``start <= day < end``."""
    last = end - dt.timedelta(days=1)
    y, m = F.col(year), F.col(month)
    return (
        ((y > start.year) | ((y == start.year) & (m >= start.month)))
        & ((y < last.year) | ((y == last.year) & (m <= last.month)))
    )
