"""Calendar helpers: month bounds as ranges, week and month labels, durations."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F


def as_date(value: date | str) -> date:
    """Accept a date, a datetime or ISO text."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value[:10])


def as_datetime(value: date | datetime | str) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def month_bounds(month: date | str) -> tuple[date, date]:
    """First day of the month and of the next one, for a half-open range."""
    first = as_date(month).replace(day=1)
    following = (first + timedelta(days=32)).replace(day=1)
    return first, following


def previous_month(day: date | str) -> date:
    """The same day one month earlier, clamped to the end of that month."""
    day = as_date(day)
    last_of_previous = day.replace(day=1) - timedelta(days=1)
    return last_of_previous.replace(day=min(day.day, last_of_previous.day))


def years_before(moment: datetime, years: int) -> datetime:
    """Calendar years back; 29 February clamps to the 28th."""
    try:
        return moment.replace(year=moment.year - years)
    except ValueError:
        return moment.replace(year=moment.year - years, day=28)


def month_before(moment: datetime) -> datetime:
    """One calendar month back, keeping the time of day."""
    return datetime.combine(previous_month(moment.date()), moment.time())


def lookback_moment(asof: date | str, hours: int) -> datetime:
    """Midnight of ``asof`` minus a number of hours."""
    return as_datetime(as_date(asof)) - timedelta(hours=hours)


def sunday_week(day: Column) -> Column:
    """Week of the year, Sunday first, 0 to 53 (days before the first Sunday are week 0)."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def year_week_label(day: Column) -> Column:
    """``2001/13`` with the Sunday-first week number."""
    return F.concat(F.year(day).cast("string"), F.lit("/"), sunday_week(day).cast("string"))


def month_label(day: Column) -> Column:
    """``January 2001``."""
    return F.date_format(day, "MMMM yyyy")


def duration_text(start: Column, end: Column, missing: str = "unknown") -> Column:
    """Elapsed time as ``[D day[s], ]H:MM:SS[.ffffff]``; ``missing`` if an end is absent."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    day_micros = F.lit(86_400_000_000)
    rest = F.pmod(micros, day_micros)
    days = ((micros - rest) / day_micros).cast("long")
    seconds = F.floor(rest / 1_000_000)
    fraction = rest % 1_000_000
    text = F.concat(
        F.when(days == 0, F.lit(""))
        .when(F.abs(days) == 1, F.concat(days.cast("string"), F.lit(" day, ")))
        .otherwise(F.concat(days.cast("string"), F.lit(" days, "))),
        F.floor(seconds / 3600).cast("string"),
        F.lit(":"),
        F.lpad(F.floor(seconds / 60 % 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((seconds % 60).cast("string"), 2, "0"),
        F.when(fraction == 0, F.lit("")).otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
        ),
    )
    return F.coalesce(text, F.lit(missing))


def lookback_label(hours: int, asof: date | str) -> str:
    """``Yesterday`` for up to a day, otherwise the ISO date looked back to."""
    if hours <= 24:
        return "Yesterday"
    return lookback_moment(asof, hours).date().isoformat()
