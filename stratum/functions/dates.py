"""Date and time features as Column expressions (session time zone UTC)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The input date formats the loan data documents.
DATE_FORMATS = ("dd-MM-yyyy", "MM/dd/yyyy", "yyyy-MM-dd")
# Leap year used to turn (month, day) into a day of the year.
DAY_OF_YEAR_BASE_YEAR = 2000


def time_to_epoch(c: Column, is_text: bool = False) -> Column:
    """Timestamp (or timestamp text) to epoch seconds as DOUBLE; unparseable -> NULL."""
    ts = F.try_to_timestamp(c) if is_text else c
    return F.unix_timestamp(ts).cast("double")


def parse_date_multi(c: Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Text date in any of ``formats`` (first match wins); NULL when none parses."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("date")


def calendar_part_exprs(d: Column, prefix: str) -> list[tuple[str, Column]]:
    """``(name, expression)`` for year, month and day of week (Monday = 0) of a date."""
    return [
        (f"{prefix}_year", F.year(d)),
        (f"{prefix}_month", F.month(d)),
        (f"{prefix}_dayofweek", F.weekday(d)),
    ]


def calendar_parts(d: Column, prefix: str) -> list[Column]:
    """Year, month and day of week (Monday = 0) of a date, as named columns."""
    return [e.alias(n) for n, e in calendar_part_exprs(d, prefix)]


def _whole(c: Column) -> Column:
    x = c.try_cast("double")
    return F.when(x == F.floor(x), x.try_cast("int"))


def day_of_year(month: Column, day: Column) -> Column:
    """Day of the year of (month, day) in a leap year; invalid or fractional -> NULL."""
    m, d = _whole(month), _whole(day)
    text = F.format_string(f"{DAY_OF_YEAR_BASE_YEAR}-%02d-%02d", m, d)
    return F.dayofyear(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))
