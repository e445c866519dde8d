"""Derived measures of players, users, line-ups and betting lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatecraft.functions.numeric import percent, ratio, round_to
from slatecraft.functions.text import tier


def value_per_thousand(points: Column, salary: Column) -> Column:
    return F.try_divide(points, salary / F.lit(1000.0))


def projection_error(actual: Column, projected: Column) -> Column:
    return actual - projected


def cash_rate(cashing: Column, rosters: Column) -> Column:
    return round_to(percent(cashing, rosters), 2)


def share_true(flag: Column) -> Column:
    """Aggregate: share of rows with a true flag, unknown counting as false."""
    return F.avg(F.coalesce(flag.cast("int"), F.lit(0)))


def diversity_class(unique: Column, total: Column) -> Column:
    share = ratio(unique, total)
    return (
        F.when(unique == total, "Full Diversity")
        .when(share > 0.8, "High Diversity")
        .when(share > 0.5, "Medium Diversity")
        .otherwise("Low Diversity")
    )


def ownership_tier(ownership: Column) -> Column:
    return tier(ownership, ((10, "Low"), (25, "Medium")), "High", inclusive=False)


def lineup_ownership_tier(ownership: Column) -> Column:
    return tier(ownership, ((10, "Low Owned"), (20, "Medium Owned")), "High Owned", inclusive=False)


def american_number(odds: Column) -> Column:
    """``'+110'`` -> 110.0, ``'-3.5'`` -> -3.5, ``'EVEN'`` or empty -> null."""
    return F.trim(odds).try_cast("double")


def line_moved(opened: Column, closed: Column) -> Column:
    return opened != closed


def movement(opened: Column, closed: Column) -> Column:
    return closed - opened
