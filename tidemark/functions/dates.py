"""Calendar expressions. Every "now" is an explicit ``as_of`` column, never the wall clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PERIODS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def as_of(text: str) -> Column:
    """A fixed point in time as a zone-free timestamp."""
    return F.lit(text).cast("timestamp_ntz")


def _check(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    return period


def add_periods(value: Column, period: str, n: int | Column) -> Column:
    """Shift by a number of calendar periods; months clamp to the month's last day."""
    return F.timestamp_add(_check(period).upper(), n if isinstance(n, Column) else F.lit(n), value)


def truncate(value: Column, period: str) -> Column:
    return F.date_trunc(_check(period), value).cast("timestamp_ntz")


def boundaries_between(start: Column, end: Column, period: str) -> Column:
    """Number of period boundaries crossed going from ``start`` to ``end``; weeks turn on Sunday."""
    _check(period)
    if period in ("month", "quarter", "year"):
        months = lambda c: F.year(c) * 12 + F.month(c) - 1
        size = {"month": 1, "quarter": 3, "year": 12}[period]
        return (F.floor(months(end) / size) - F.floor(months(start) / size)).cast("bigint")
    if period == "week":
        sundays = lambda c: F.floor((F.unix_date(c.cast("date")) + 4) / 7)
        return (sundays(end) - sundays(start)).cast("bigint")
    if period == "day":
        return F.datediff(end, start).cast("bigint")
    seconds = {"hour": 3600, "minute": 60, "second": 1}[period]
    stamp = lambda c: F.floor(F.unix_seconds(c.cast("timestamp")) / seconds)
    return (stamp(end) - stamp(start)).cast("bigint")


def day_of_week(day: Column, iso: bool = True) -> Column:
    """1 = Monday in the ISO form, 1 = Sunday otherwise."""
    return (F.weekday(day) + 1) if iso else F.dayofweek(day)


def day_of_month(day: Column) -> Column:
    return F.dayofmonth(day)


def day_of_year(day: Column) -> Column:
    return F.dayofyear(day)


def date_part(part: str, day: Column) -> Column:
    return F.date_part(F.lit(part), day)


def day_name(day: Column, short: bool = True) -> Column:
    return F.date_format(day, "EEE" if short else "EEEE")


def month_name(day: Column, short: bool = True) -> Column:
    return F.date_format(day, "MMM" if short else "MMMM")


def iso_week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def iso_week_end(day: Column) -> Column:
    return F.date_add(iso_week_start(day), 6)


def iso_week_of_year(day: Column) -> Column:
    return F.weekofyear(day)


def week_start(day: Column) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(day.cast("date"), F.dayofweek(day) - 1)


def week_end(day: Column) -> Column:
    return F.date_add(week_start(day), 6)


def week_of_year(day: Column) -> Column:
    """Weeks counted from 1 January; distinct from the ISO week."""
    return F.ceil(F.dayofyear(day) / 7).cast("int")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_end(day: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)


def year_end(day: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(day, "year"), 12), 1)


def today(now: Column) -> Column:
    return now.cast("date")


def n_days_ago(n: int, day: Column) -> Column:
    return F.date_sub(day.cast("date"), n)


def n_days_away(n: int, day: Column) -> Column:
    return F.date_add(day.cast("date"), n)


def yesterday(day: Column) -> Column:
    return n_days_ago(1, day)


def tomorrow(day: Column) -> Column:
    return n_days_away(1, day)


def n_weeks_ago(n: int, day: Column) -> Column:
    """Start (Monday) of the week n weeks back."""
    return iso_week_start(n_days_ago(7 * n, day))


def n_weeks_away(n: int, day: Column) -> Column:
    return n_weeks_ago(-n, day)


def n_months_ago(n: int, day: Column) -> Column:
    """First day of the month n months back."""
    return F.trunc(F.add_months(day.cast("date"), -n), "month")


def n_months_away(n: int, day: Column) -> Column:
    return n_months_ago(-n, day)


def last_week(day: Column) -> Column:
    return n_weeks_ago(1, day)


def next_week(day: Column) -> Column:
    return n_weeks_away(1, day)


def last_month(day: Column) -> Column:
    return n_months_ago(1, day)


def next_month(day: Column) -> Column:
    return n_months_away(1, day)


def last_month_number(day: Column) -> Column:
    return F.month(last_month(day))


def next_month_number(day: Column) -> Column:
    return F.month(next_month(day))


def last_month_name(day: Column, short: bool = True) -> Column:
    return month_name(last_month(day), short)


def next_month_name(day: Column, short: bool = True) -> Column:
    return month_name(next_month(day), short)


def periods_since(start: Column, now: Column, period: str = "day") -> Column:
    return boundaries_between(start, now, period)


def from_unixtimestamp(epochs: Column, unit: str = "seconds") -> Column:
    """Epoch number to a UTC timestamp."""
    scale = {"seconds": 1000000, "milliseconds": 1000, "microseconds": 1}.get(unit)
    if scale is None:
        raise ValueError(f"unknown epoch unit {unit!r}")
    return F.timestamp_micros((epochs * scale).cast("bigint"))


def to_unixtimestamp(value: Column) -> Column:
    return F.unix_seconds(value.cast("timestamp"))


def convert_timezone(value: Column, target: str, source: str = "UTC") -> Column:
    return F.convert_timezone(F.lit(source), F.lit(target), value.cast("timestamp_ntz"))


def round_timestamp(value: Column) -> Column:
    """Nearest midnight."""
    return truncate(add_periods(value, "hour", 12), "day")
