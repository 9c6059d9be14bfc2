"""Parsing of dates, clock times and numbers; small arithmetic on them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK_SHAPE = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
ISO_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def parse_dmy(text: Column) -> Column:
    """Date from day/month/year text, NULL when it is not a real date.

    Names the text only once: a filter on the date is pushed below the projection and
    repeats the expression behind it.
    """
    return F.try_to_timestamp(F.trim(text), F.lit("d/M/yyyy")).cast("date")


def parse_iso(text: Column) -> Column:
    """Date from yyyy-MM-dd text, NULL for another shape or an impossible date."""
    return F.when(text.rlike(ISO_SHAPE), text.try_cast("date"))


def date_id(day: Column) -> Column:
    """Integer yyyyMMdd key of a date."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def campaign_date_id(year: Column) -> Column:
    """Calendar key of a yearly campaign: its first of January."""
    return (year * 10000 + 101).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def discharge_date(admission: Column, days: Column) -> Column:
    """Admission plus length of stay, NULL when either is missing."""
    return F.date_add(admission, days)


def in_year(moment: Column, year: int) -> Column:
    """Range test on a date or timestamp, so that scans can skip row groups."""
    return (moment >= F.lit(date(year, 1, 1))) & (moment < F.lit(date(year + 1, 1, 1)))


def clock_seconds(text: Column) -> Column:
    """Seconds since midnight of an HH:mm:ss text, NULL when unreadable."""
    part = lambda start: F.substring(text, start, 2).try_cast("int")
    return F.when(text.rlike(CLOCK_SHAPE), part(1) * 3600 + part(4) * 60 + part(7))


def local_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two local timestamps, whatever the session time zone."""
    return (end - start).cast("interval second").cast("long")


def duration_minutes(seconds: Column) -> Column:
    """Minutes of an interval, NULL when it is inverted or unknown."""
    return F.when(seconds >= 0, seconds / F.lit(60.0))


def decimal_comma(text: Column) -> Column:
    """Number written with a decimal comma or point, NULL when not a number."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("decimal(18,4)")


def mark_out_of_ten(score: Column) -> Column:
    """Mark with one decimal from a score out of one hundred."""
    return F.round(score / 10, 1).cast("decimal(3,1)")


def whole_percent(part: Column, whole: Column) -> Column:
    """Percentage rounded half up to an integer, NULL when the whole is zero."""
    return F.floor(100 * part / F.nullif(whole, F.lit(0)) + F.lit(0.5)).cast("int")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Percentage as a double, NULL when the whole is zero."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), digits).cast("double")
