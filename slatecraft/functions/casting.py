"""Text and number casts that never fail a whole job because of one bad value.

Spark's ANSI cast raises on ``'4.5'`` as an integer and truncates 2.5; the results to match round
half away from zero for text and half to even for doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_from_text(text: Column, to: str = "int") -> Column:
    """``'4'`` -> 4, ``'4.5'`` -> 5, ``'abc'`` -> null."""
    return F.coalesce(text.try_cast(to), F.round(text.try_cast("double")).try_cast(to))


def int_from_double(number: Column, to: str = "int") -> Column:
    """2.5 -> 2 and 3.5 -> 4 (half to even)."""
    return F.rint(number).try_cast(to)


def double_from_text(text: Column) -> Column:
    return text.try_cast("double")


def bool_from_text(text: Column) -> Column:
    return text.try_cast("boolean")


def timestamp_from_text(text: Column) -> Column:
    """Zone-free timestamp; the sentinel ``0001-01-01 00:00:00`` stays as it is."""
    return text.try_cast("timestamp_ntz")
