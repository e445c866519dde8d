"""Shares of a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.functions.numeric import percent, round_to


def over_all(value: Column) -> Column:
    """An aggregate over all rows, on every row; only for the few rows of a finished report.

    A report has one row per label (a position, a pattern, a stack size), so one task is right for
    it, and the data below it is read once instead of once more for the total.
    """
    return value.over(Window.partitionBy(F.lit(0)))


def share_of(count: str, total: Column) -> Column:
    return round_to(percent(F.col(count), total), 2)


def distribution(df: DataFrame, value: Column, name: str, count: str, share: str) -> DataFrame:
    """Rows per value and their share of all rows."""
    counted = df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias(count))
    return counted.withColumn(share, share_of(count, over_all(F.sum(count))))
