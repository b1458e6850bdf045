"""Calendar column expressions: weekday, Easter, Black Friday, holidays.

All functions return ``Column`` expressions; nothing is evaluated in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import (EASTER_OFFSETS, FIXED_HOLIDAYS, LATER_FIXED_HOLIDAYS,
                                  VALENTINE_MONTH_DAY)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def day_of_week(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def easter(year) -> Column:
    """Easter Sunday of a Gregorian ``year``: the first Sunday after the paschal
    full moon, which falls ``age`` days after March 21. The moon's age follows
    the 19-year cycle, shifted by the century's skipped leap days and lunar
    correction; the two last ages are pulled in by a day."""
    y = _c(year).cast("int")
    cycle = F.pmod(y, F.lit(19))
    century = F.floor(y / 100).cast("int")
    skipped = century - F.floor(century / 4).cast("int")
    lunar = F.floor((century * 8 + 13) / 25).cast("int")
    age = F.pmod(skipped - lunar + cycle * 19 + 15, F.lit(30))
    late = (age == 29) | ((age == 28) & (cycle > 10))
    moon = F.date_add(F.make_date(y, F.lit(3), F.lit(21)), (age - late.cast("int")).cast("int"))
    return F.next_day(moon, "SUN")


def black_friday(year) -> Column:
    """Friday after the fourth Thursday of November."""
    y = _c(year).cast("int")
    first_thursday = F.next_day(F.make_date(y, F.lit(10), F.lit(31)), "THU")
    return F.date_add(first_thursday, 22)


def valentine(year) -> Column:
    """The June 12 valentine's day of the events calendar."""
    m, d = VALENTINE_MONTH_DAY
    return F.make_date(_c(year).cast("int"), F.lit(m), F.lit(d))


def is_holiday(d) -> Column:
    """True when ``d`` is a non-operational holiday of its own year.

    Every holiday of year Y falls in year Y, so testing the row's own year
    equals testing membership in the set built for a range of years — and
    needs no join, no subquery and no pass over the data.
    """
    d = _c(d)
    y, m, dd = F.year(d), F.month(d), F.dayofmonth(d)
    fixed = [(m == mm) & (dd == x) for mm, x in FIXED_HOLIDAYS]
    fixed += [(y >= first) & (m == mm) & (dd == x) for first, mm, x in LATER_FIXED_HOLIDAYS]
    delta = F.datediff(d, easter(y))
    movable = delta.isin(list(EASTER_OFFSETS))
    out = movable
    for f in fixed:
        out = out | f
    return out


def holiday_dates_for_years(years: DataFrame, year_col: str = "year",
                            out_col: str = "holiday_date") -> DataFrame:
    """Non-operational holidays of each year in ``years``: the fixed-date
    national list, later additions from their first year, and the
    Easter-relative days (Good Friday, Carnival Monday/Tuesday, Corpus
    Christi). Deduplicated: one row per date.
    """
    y = F.col(year_col).cast("int")
    e = easter(y)
    dates = [F.make_date(y, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    dates += [F.when(y >= first, F.make_date(y, F.lit(m), F.lit(d)))
              for first, m, d in LATER_FIXED_HOLIDAYS]
    dates += [F.date_add(e, off) for off in EASTER_OFFSETS]
    return (years.select(F.explode(F.array(*dates)).alias(out_col))
            .where(F.col(out_col).isNotNull()).distinct())


def holiday_dates(df: DataFrame, date_col: str, out_col: str = "holiday_date") -> DataFrame:
    """Holidays for every year from the min to the max year of ``df``.

    The year range is a lazy scalar subquery; the result has at most
    ``13 x years`` rows, a bound set by the calendar, not by the data.
    """
    bounds = df.agg(F.min(F.year(date_col)).alias("lo"), F.max(F.year(date_col)).alias("hi"))
    years = bounds.select(F.explode(F.sequence("lo", "hi")).alias("year"))
    return holiday_dates_for_years(years, "year", out_col)
