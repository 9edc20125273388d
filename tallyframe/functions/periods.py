"""Half-open date ranges, which reach the file scan where a year or quarter function would not."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

Bounds = tuple[dt.date, dt.date]


def year_bounds(year: int) -> Bounds:
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def quarter_bounds(day: dt.date | None) -> Bounds | None:
    """The quarter that holds ``day``; None stays None."""
    if day is None:
        return None
    first = 3 * ((day.month - 1) // 3) + 1
    end = dt.date(day.year + 1, 1, 1) if first == 10 else dt.date(day.year, first + 3, 1)
    return dt.date(day.year, first, 1), end


def within(column: Column, bounds: Bounds | None) -> Column:
    """True inside the range; an unknown range holds nothing."""
    if bounds is None:
        return F.lit(False)
    return (column >= F.lit(bounds[0])) & (column < F.lit(bounds[1]))


def in_quarter_of(column: Column, day: dt.date | None) -> Column:
    """True in the quarter that holds ``day``; without a day never."""
    return within(column, quarter_bounds(day))


def in_current_quarter(column: Column) -> Column:
    """True in the quarter of the day the query runs; the bounds are constants by the time files are read."""
    first = F.trunc(F.current_date(), "quarter")
    return (column >= first) & (column < F.add_months(first, 3))


def since(column: Column, day: dt.date) -> Column:
    return column >= F.lit(day)


def years_until(year: Column, as_of: dt.date | None) -> Column:
    """Whole calendar years from ``year`` to the year of ``as_of`` (today when None)."""
    now = F.year(F.current_date()) if as_of is None else F.lit(as_of.year)
    return (now - year).cast("int")


def plus_days(moment: Column, days: Column) -> Column:
    return moment + F.make_dt_interval(days=days.cast("int"))
