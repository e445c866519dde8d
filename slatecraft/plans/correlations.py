"""Correlation of the points of player pairs that met in one event."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.numeric import correlation_from_moments, deviation_from_moment
from slatecraft.functions.text import LINE_TEAM_CODES, clean_name, merge_wings, name_within, recode
from slatecraft.operators.keyed import nulls_last, top1_per_key
from slatecraft.operators.pairs import BITS, pair_moments

MORE_THAN = 50


def performances(players: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per player, event and team: the one with the lowest positive projection.

    A captain row projects higher than the ordinary row of the same player, so the latter stays.
    """
    keys = ["player_id", "event_id", "event_team_id"]
    rows = players.filter(F.col("proj_points") > 0).select(
        *keys, "proj_points", "actual_points", "position", *extra
    )
    return top1_per_key(rows, keys, [*nulls_last(F.col("proj_points")), *nulls_last(F.col("actual_points"))])


def _correlation():
    return correlation_from_moments(F.col("m2_1"), F.col("m2_2"), F.col("products"))


def position_correlations(players: DataFrame, more_than: int = MORE_THAN, bits: int = BITS) -> DataFrame:
    """Correlation per ordered position pair and team relationship."""
    sums = pair_moments(
        performances(players), "event_id", "player_id", "event_team_id", ["position"],
        F.col("actual_points"), bits, players,
    )
    return sums.filter(F.col("pairs") > more_than).select(
        "position_1",
        "position_2",
        "team_relationship",
        _correlation().alias("correlation"),
        F.col("pairs").cast("long").alias("sample_size"),
    )


def with_lines(played: DataFrame, lines: DataFrame, team_codes: Mapping[str, str] = LINE_TEAM_CODES) -> DataFrame:
    """Line of each player by team, day and surname; an equi join with the name test on top.

    A name may match several line entries (a surname contained in a full name); all are kept.
    """
    listed = lines.select(
        F.to_date("game_date").alias("game_date"),
        recode(F.col("team"), team_codes).alias("current_team"),
        clean_name(F.col("last_name")).alias("listed_name"),
        "line",
    )
    named = (F.col("clean_last_name") == F.col("listed_name")) | name_within(
        F.upper("full_name"), F.col("listed_name")
    )
    same_team = played["current_team"] == listed["current_team"]
    same_day = played["game_date"] == listed["game_date"]
    return played.join(listed, same_team & same_day & named, "left").select(
        *[played[c] for c in played.columns], "line"
    )


def line_correlations(
    players: DataFrame,
    lines: DataFrame,
    team_codes: Mapping[str, str] = LINE_TEAM_CODES,
    more_than: int = MORE_THAN,
    bits: int = BITS,
) -> DataFrame:
    """As above, but per position and line of both players, for players with a known line."""
    played = performances(players, ("full_name", "last_name", "current_team", "game_date")).select(
        "player_id",
        "event_id",
        "event_team_id",
        "actual_points",
        "full_name",
        clean_name(F.col("last_name")).alias("clean_last_name"),
        merge_wings(F.col("position")).alias("position"),
        "current_team",
        F.to_date("game_date").alias("game_date"),
    )
    lined = with_lines(played, lines, team_codes).filter(F.col("line").isNotNull())
    sums = pair_moments(
        lined, "event_id", "player_id", "event_team_id", ["position", "line"], F.col("actual_points"),
        bits, players.withColumn("position", merge_wings(F.col("position"))),
    )
    return sums.filter(F.col("pairs") > more_than).select(
        "position_1",
        "position_2",
        "team_relationship",
        "line_1",
        "line_2",
        _correlation().alias("correlation"),
        F.col("pairs").cast("long").alias("sample_size"),
        F.col("all_mean_1").alias("avg_points_1"),
        F.col("all_mean_2").alias("avg_points_2"),
        deviation_from_moment(F.col("known_1"), F.col("all_m2_1")).alias("stddev_points_1"),
        deviation_from_moment(F.col("known_2"), F.col("all_m2_2")).alias("stddev_points_2"),
    )


def strongest_first(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc_nulls_last("correlation"))
