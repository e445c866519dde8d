"""Analyst reports on the normalised tables and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.metrics import (
    cash_rate,
    diversity_class,
    lineup_ownership_tier,
    ownership_tier,
    share_true,
    value_per_thousand,
)
from slatecraft.operators.keyed import counts_joined
from slatecraft.operators.ranking import add_rank
from slatecraft.operators.reshape import slot_columns, unpivot_filled



def slates_on_day(draft_groups: DataFrame, date_id: int) -> DataFrame:
    return (
        draft_groups.filter(F.col("date_id") == date_id)
        .select("draft_group_id", "contest_start_date", "game_count", "contest_suffix", "source_name")
        .orderBy("contest_start_date", "draft_group_id")
    )


def slate_structure(draft_groups: DataFrame, first: int, last: int) -> DataFrame:
    return (
        draft_groups.filter(F.col("date_id").between(first, last))
        .groupBy("source_id", "display_name")
        .agg(F.avg("game_count").alias("avg_games"), F.count("*").alias("slate_count"))
    )


def value_plays(players: DataFrame, top: int = 20) -> DataFrame:
    """Most points per thousand of salary; ties by player id."""
    return (
        players.filter(F.col("actual_points") > 0)
        .select(
            "player_id",
            "full_name",
            "salary",
            "actual_points",
            value_per_thousand(F.col("actual_points"), F.col("salary")).alias("value"),
        )
        .orderBy(F.desc_nulls_last("value"), "player_id")
        .limit(top)
    )


def points_by_ownership(players: DataFrame) -> DataFrame:
    return players.groupBy(ownership_tier(F.col("ownership")).alias("ownership_tier")).agg(
        F.avg("actual_points").alias("avg_points"), F.count("*").alias("player_count")
    )


def best_users(users: DataFrame, min_rosters: int = 10, top: int = 50) -> DataFrame:
    """Users by return; ties by user and contest."""
    return (
        users.filter(F.col("total_rosters") >= min_rosters)
        .orderBy(F.desc_nulls_last("roi"), "user_id", "contest_id")
        .select(
            "user_id",
            "total_rosters",
            "lineups_cashing",
            cash_rate(F.col("lineups_cashing"), F.col("total_rosters")).alias("cash_rate"),
            "roi",
        )
        .limit(top)
    )


def return_by_diversity(users: DataFrame, min_rosters: int = 20) -> DataFrame:
    strategy = diversity_class(F.col("unique_rosters"), F.col("total_rosters"))
    return (
        users.filter(F.col("total_rosters") >= min_rosters)
        .groupBy(strategy.alias("strategy"))
        .agg(F.avg("roi").alias("avg_roi"), F.count("*").alias("user_count"))
    )


def most_repeated(user_lineups: DataFrame, top: int = 100) -> DataFrame:
    return (
        user_lineups.filter(F.col("lineup_ct") > 1)
        .select("user_id", "lineup_hash", "lineup_ct")
        .orderBy(F.desc_nulls_last("lineup_ct"), "user_id", "lineup_hash")
        .limit(top)
    )


def user_lineup_results(users: DataFrame, user_lineups: DataFrame, lineups: DataFrame) -> DataFrame:
    """Users with each of their line-ups and its result."""
    entries = user_lineups.select("contest_id", "user_id", "lineup_hash")
    results = lineups.select("contest_id", "lineup_hash", "points", "is_cashing")
    return (
        users.select("contest_id", "user_id", "roi")
        .join(entries, ["contest_id", "user_id"])
        .join(results, ["contest_id", "lineup_hash"])
        .select("user_id", "roi", "lineup_hash", "points", "is_cashing")
    )


def results_above(users: DataFrame, user_lineups: DataFrame, lineups: DataFrame, roi: float = 50) -> DataFrame:
    return user_lineup_results(users.filter(F.col("roi") > roi), user_lineups, lineups)


def results_with_totals(users: DataFrame, user_lineups: DataFrame, lineups: DataFrame) -> DataFrame:
    """The same rows with the number of rows of their user."""
    return counts_joined(user_lineup_results(users, user_lineups, lineups), ["user_id"], "user_total_lineups")


def contrarian_lineups(lineups: DataFrame, below: float = 15, top: int = 50) -> DataFrame:
    """Line-ups in the money that few others owned."""
    return (
        lineups.filter(F.col("is_cashing") & (F.col("avg_own") < below))
        .orderBy(F.desc_nulls_last("lineup_percentile"), "lineup_hash")
        .select("lineup_hash", "points", "avg_own", "lineup_rank", "payout")
        .limit(top)
    )


def results_by_stack_size(lineups: DataFrame) -> DataFrame:
    return lineups.groupBy(F.col("correlated_players").alias("stack_size")).agg(
        F.avg("points").alias("avg_points"),
        share_true(F.col("is_cashing")).alias("cash_rate"),
        F.count("*").alias("lineup_count"),
    )


def rebuilt_lineups(
    lineups: DataFrame, players: DataFrame, slots: Mapping[str, str], top: int | None = 10
) -> DataFrame:
    """Line-ups in the money with name and points of the player in each of the given slots.

    ``slots`` maps an output prefix to a slot. One join for all slots instead of one per slot; a
    line-up shows up only when all of them are found, and ``player_id`` is unique in ``players``.
    """
    names = {s: out for out, s in slots.items()}
    key = ["contest_id", "lineup_hash"]
    cells = unpivot_filled(
        lineups.filter(F.col("is_cashing")),
        [*key, "points", "total_salary"],
        slot_columns(list(names)),
        "slot",
        "player_id",
    )
    details = players.select("player_id", "full_name", "actual_points")
    wide = (
        cells.join(details, "player_id")
        .groupBy(*key)
        .agg(
            F.max("points").alias("points"),
            F.max("total_salary").alias("total_salary"),
            F.count("*").alias("_found"),
            *[
                cell
                for s, out in names.items()
                for cell in (
                    F.max(F.when(F.col("slot") == f"pos_{s}", F.col("full_name"))).alias(f"{out}_name"),
                    F.max(F.when(F.col("slot") == f"pos_{s}", F.col("actual_points"))).alias(f"{out}_points"),
                )
            ],
        )
        .filter(F.col("_found") == len(names))
        .drop("_found")
    )
    ordered = wide.orderBy(F.desc_nulls_last("points"), *key)
    return ordered.limit(top).drop("contest_id") if top else wide.drop("contest_id")


def results_by_ownership(lineups: DataFrame) -> DataFrame:
    return lineups.groupBy(lineup_ownership_tier(F.col("avg_own")).alias("ownership_tier")).agg(
        F.avg("points").alias("avg_points"),
        F.avg("lineup_percentile").alias("avg_percentile"),
        share_true(F.col("is_cashing")).alias("cash_rate"),
    )


def player_results(players: DataFrame, lineups: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Per player: in how many line-ups, and how those did.

    The slots become rows and join on equality, which replaces a join on "any slot equals". A
    player in several slots of a line-up counts once for it: repeats go inside the row, without a
    shuffle, and the counts below are merged before theirs.
    """
    held = F.array_distinct(F.array(*slot_columns(slots)))
    rostered = lineups.select("points", "is_cashing", F.explode(held).alias("player_id")).filter(
        F.col("player_id").isNotNull()
    )
    per_player = rostered.groupBy("player_id").agg(
        F.count("*").alias("times_rostered"),
        F.avg("points").alias("avg_lineup_points"),
        share_true(F.col("is_cashing")).alias("cash_rate"),
    )
    columns = ["player_id", "full_name", "salary", "ownership", "actual_points"]
    return players.select(*columns).join(per_player, "player_id").drop("player_id")


def returns_per_user(mart: DataFrame) -> DataFrame:
    """Sum of returns per user and slate type over all contest sizes."""
    return mart.groupBy("slate_type", "user_id").agg(F.sum("roi").alias("roi_sum"))


def ranked_users(mart: DataFrame) -> DataFrame:
    """Users with a positive return, ranked within their slate type."""
    positive = returns_per_user(mart).filter(F.col("roi_sum") > 0)
    return add_rank(positive, "roi_sum", ["slate_type"], "user_rank")


def users_per_slate(mart: DataFrame) -> DataFrame:
    return mart.groupBy("slate_type").agg(F.count_distinct("user_id").alias("users"))


def correlation_grid(mart: DataFrame, relation: str = "same_team") -> DataFrame:
    """Mean correlation per position pair: the cells of a heat map."""
    return (
        mart.filter(F.col("team_relationship") == relation)
        .groupBy("position_1", "position_2")
        .agg(F.avg("correlation").alias("avg_correlation"))
    )


def wide_grid(mart: DataFrame, positions: Sequence[str], relation: str = "same_team") -> DataFrame:
    """The heat map as a table with one column per second position."""
    return (
        mart.filter(F.col("team_relationship") == relation)
        .groupBy("position_1")
        .pivot("position_2", list(positions))
        .agg(F.avg("correlation"))
    )
