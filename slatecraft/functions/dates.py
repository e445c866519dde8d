"""Date keys, month ranges and date parts of file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(day: Column) -> Column:
    """Date (or ISO text) as an integer ``YYYYMMDD``."""
    return F.date_format(day.cast("date"), "yyyyMMdd").cast("int")


def day_from_id(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def within_ids(key: Column, start: str | None = None, end: str | None = None) -> Column:
    """Inclusive range on an integer date key; either bound (ISO text) may be missing."""
    test = F.lit(True)
    if start:
        test = test & (key >= int(start.replace("-", "")))
    if end:
        test = test & (key <= int(end.replace("-", "")))
    return test


def previous_month(day: Column) -> tuple[Column, Column]:
    """First and last day of the calendar month before ``day``."""
    first = F.add_months(F.trunc(day, "MM"), -1)
    return first, F.last_day(first)


def months_touched(start: Column, end: Column) -> Column:
    """First days of all months from ``start`` to ``end``."""
    return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))


def path_part(path: Column, index: int) -> Column:
    """A folder of a file path, counted from the end (-1 is the file name)."""
    return F.split_part(path, F.lit("/"), F.lit(index))
