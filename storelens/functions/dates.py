"""Calendar expressions: literals, holidays, ship dates."""

from __future__ import annotations

from calendar import isleap
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.ratios import is_true
from storelens.functions.text import nonempty

MONDAY, THURSDAY, FRIDAY = 0, 3, 4

# Federal holidays on a fixed day, as (month, day).
FIXED_HOLIDAYS = ((1, 1), (7, 4), (11, 11), (12, 25))
JUNETEENTH, JUNETEENTH_SINCE = (6, 19), 2021

# Federal holidays on a weekday, as month and range of days.
MONDAY_HOLIDAYS = ((1, 15, 21), (2, 15, 21), (5, 25, 31), (9, 1, 7), (10, 8, 14))
THANKSGIVING = (11, 22, 28)

# How a date is written somewhere in a ship-date cell, and the
# word that asks for the earliest date.
SHIP_DATE_PATTERN = r"([0-9]{1,2})[/\-]([0-9]{1,2})(?:[/\-]([0-9]{2,4}))?"
SHIP_ASAP = "ASAP"
SHIP_DATE_LAYOUT = "MM/dd/yyyy"


def ts(moment: datetime) -> Column:
    """Timestamp literal without a time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def cutoff(as_of: datetime, days: int) -> Column:
    """Start of a trailing window, exact to the moment."""
    return ts(as_of - timedelta(days=days))


def extract_since(as_of: datetime, days: int) -> datetime:
    """Lower bound of an extract: the whole first day is included."""
    return datetime.combine((as_of - timedelta(days=days)).date(), datetime.min.time())


def _near(days: tuple[tuple[int, int], ...], shift: int) -> list[int]:
    """Month-day numbers of the given days moved by ``shift`` days."""
    moved = [datetime(2001, m, d) + timedelta(days=shift) for m, d in days]
    return [day.month * 100 + day.day for day in moved]


def is_us_holiday(c: Column, years: tuple[int, int] | None = None) -> Column:
    """Whether a date is a federal holiday or the workday it is observed on.

    A fixed holiday on a Saturday is observed the Friday before, one on a
    Sunday the Monday after. ``years`` limits the calendar to an inclusive
    range; by default it covers every year of the data.
    """
    month_day = F.month(c) * 100 + F.dayofmonth(c)
    weekday = F.weekday(c)

    def fixed(days: tuple[tuple[int, int], ...]) -> Column:
        return (
            month_day.isin(_near(days, 0))
            | ((weekday == FRIDAY) & month_day.isin(_near(days, -1)))
            | ((weekday == MONDAY) & month_day.isin(_near(days, 1)))
        )

    mondays = [m * 100 + d for m, first, last in MONDAY_HOLIDAYS for d in range(first, last + 1)]
    month, first, last = THANKSGIVING
    found = (
        fixed(FIXED_HOLIDAYS)
        | (fixed((JUNETEENTH,)) & (F.year(c) >= JUNETEENTH_SINCE))
        | ((weekday == MONDAY) & month_day.isin(mondays))
        | ((weekday == THURSDAY) & month_day.between(month * 100 + first, month * 100 + last))
    )
    return found & F.year(c).between(*years) if years else found


def day_type(c: Column, years: tuple[int, int] | None = None) -> Column:
    """``holiday`` on weekends and federal holidays, else ``workday``; null stays null."""
    off = (F.weekday(c) >= 5) | is_us_holiday(c, years)
    return F.when(c.isNull(), None).when(off, "holiday").otherwise("workday")


def with_ship_date(
    df: DataFrame, source: str, as_of: datetime, cleaned: str, defaulted: str
) -> DataFrame:
    """Add the cleaned ship date and whether it fell back to tomorrow.

    The first month/day(/year) anywhere in the text counts. Without a year the
    next such date that has not begun yet is meant. Every step is a column of
    its own, so that what later steps use several times is computed once.
    """
    raw = nonempty(F.col(source))
    written = F.when(F.upper(raw) != SHIP_ASAP, F.regexp_extract(raw, SHIP_DATE_PATTERN, 0))
    month, day, year = F.col("__month"), F.col("__day"), F.col("__year")
    numbers = {
        f"__{name}": F.get("__parts", F.lit(i)).try_cast("int")
        for i, name in enumerate(("month", "day", "year"))
    }
    this = month * 100 + day
    today = as_of.month * 100 + as_of.day
    begun = this < today if as_of.time() == datetime.min.time() else this <= today
    no_leap_day = (this == 229) & F.lit(not isleap(as_of.year))
    full_year = (
        F.when(year.isNull() & ~no_leap_day, F.lit(as_of.year) + begun.cast("int"))
        .when(year < 50, year + 2000)
        .when(year < 100, year + 1900)
        .otherwise(year)
    )
    first = F.when(month.between(1, 12) & (day > 0), F.make_date("__year", month, F.lit(1)))
    found = F.when(F.month("__date") == month, F.date_format("__date", SHIP_DATE_LAYOUT))
    tomorrow = F.lit((as_of + timedelta(days=1)).strftime("%m/%d/%Y"))
    return (
        df.withColumn("__parts", F.split(F.coalesce(written, F.lit("")), r"[/\-]"))
        .withColumns(numbers)
        .withColumn("__year", full_year)
        .withColumn("__date", F.date_add(first, day - 1))
        .withColumn("__found", found)
        .withColumns(
            {cleaned: F.coalesce("__found", tomorrow), defaulted: F.col("__found").isNull()}
        )
        .drop("__parts", *numbers, "__date", "__found")
    )


def within(c: Column, start: datetime, end: datetime) -> Column:
    """Closed interval test; null counts as outside."""
    return is_true(c.between(ts(start), ts(end)))
