"""Make-up of the best single-game line-ups: captain positions, defences and their opponents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.stacks import slot_entries, team_of
from slatecraft.functions.text import DEFENCE
from slatecraft.operators.shares import distribution
from slatecraft.plans.top_lineups import SINGLE_GAME_SLOTS


def _distribution(df: DataFrame, value: Column, name: str) -> DataFrame:
    return distribution(df, value, name, "lineup_count", "pct_of_lineups")


def captain_positions(mart: DataFrame, slot: str = "cpt1") -> DataFrame:
    """Share of each position in the captain slot."""
    filled = mart.filter(F.col(f"pos_{slot}_real").isNotNull())
    return _distribution(filled, F.col(f"pos_{slot}_real"), "captain_position")


def defences_per_lineup(mart: DataFrame, slots: Sequence[str] = SINGLE_GAME_SLOTS) -> DataFrame:
    """How many line-ups use no, one or more defences."""
    defences = F.size(F.filter(slot_entries(slots), lambda e: e["position"] == DEFENCE))
    return _distribution(mart, defences, "defences")


def opponents_of_defence(mart: DataFrame, slots: Sequence[str] = SINGLE_GAME_SLOTS) -> DataFrame:
    """For line-ups with a defence: how many players are of another team."""
    teamed = (
        mart.select(slot_entries(slots).alias("entries"))
        .withColumn("dst_team", team_of(F.col("entries"), DEFENCE))
        .filter(F.col("dst_team").isNotNull())
    )
    others = F.size(F.filter("entries", lambda e: e["team"] != F.col("dst_team")))
    return _distribution(teamed, others, "opponents")
