"""Dates held as text of mixed precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted shapes in order of preference, with the pattern each is read by.
_YEAR = r"(?!0000)\d{4}"
_MONTH = r"(0?[1-9]|1[0-2])"
_DAY = r"([0 ]?[1-9]|[12]\d|3[01])"
DATE_SHAPES = (
    (rf"^{_YEAR}-{_MONTH}-{_DAY}\z", "yyyy-M-d"),
    (rf"^{_YEAR}-{_MONTH}\z", "yyyy-M"),
    (rf"^{_YEAR}\z", "yyyy"),
    (rf"^{_MONTH}/{_DAY}/{_YEAR}\z", "M/d/yyyy"),
    (rf"^{_DAY}/{_MONTH}/{_YEAR}\z", "d/M/yyyy"),
)


def parsed_date(text: Column) -> Column:
    """First reading that gives a valid date of year 1 or later; null if none does.

    Partial dates become the first of their month or year, and month-first wins over
    day-first where both are possible. Shapes are checked before parsing, so that a failed
    parse (and its exception) is left to days a month does not have.
    """
    compact = F.replace(text, F.lit(" "), F.lit(""))
    return F.coalesce(*[
        F.when(text.rlike(shape), F.try_to_date(compact, pattern)) for shape, pattern in DATE_SHAPES
    ])


def dates_are_close(a: Column, b: Column, days: int) -> Column:
    """Both texts are dates, at most ``days`` apart."""
    gap = F.abs(F.datediff(parsed_date(a), parsed_date(b)))
    return F.coalesce(gap <= days, F.lit(False))


def day_number(date: Column) -> Column:
    """Days since 1970-01-01, as int."""
    return F.datediff(date, F.lit("1970-01-01").cast("date"))


def utc_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
