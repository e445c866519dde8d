"""One row per key, key filters and joins with a role."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the smallest ``order`` per key, as an aggregate with map-side combine.

    Unlike a row number in a window this never sorts a whole key in one task. Columns outside the
    key break ties after ``order``, so the chosen row is always the same.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [c.alias(f"_order_{i}") for i, c in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranks, *rest)).alias("_row"))
    return best.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def nulls_last(value: Column) -> list[Column]:
    """Order columns that put missing values behind all others."""
    return [value.isNull(), value]


def descending(value: Column) -> list[Column]:
    """Order columns for numbers, largest first and missing values last."""
    return [value.isNull(), -value]


def distinct_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; the smallest by the remaining columns, so the choice is repeatable."""
    return top1_per_key(df, keys, [])


def semi_prefilter(df: DataFrame, needed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs on the other side."""
    return df.join(needed.select(*keys), list(keys), "left_semi")


def symmetric_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values found on one side only, with the side they come from; one pass, one shuffle."""
    both = left.select(column, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(column, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = both.groupBy(column).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.filter(F.col("l") != F.col("r")).select(
        column, F.when(F.col("l") == 1, "left").otherwise("right").alias("only_in")
    )


def slot_role(slot: Column, roles: Mapping[str, str]) -> Column:
    """Roster role a slot asks for; ``*`` for slots without a special role."""
    chosen = F
    for name, role in roles.items():
        chosen = chosen.when(slot == F.lit(name), F.lit(role))
    return chosen.otherwise(F.lit("*")) if roles else F.lit("*")


def player_role(roster_position: Column, roles: Mapping[str, str]) -> Column:
    """Role a player row can fill; null (never joins) for an unknown roster position."""
    if not roles:
        return F.lit("*")
    special = sorted(set(roles.values()))
    return F.when(roster_position.isin(*special), roster_position).when(
        roster_position.isNotNull(), F.lit("*")
    )


def counts_joined(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the number of rows per key.

    Counting first and joining back keeps a key with very many rows spread over tasks, which a
    window partitioned by the key would not.
    """
    return df.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), list(keys))
