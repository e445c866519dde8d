"""How much of a user's line-ups in a contest rests on one player."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.numeric import ratio
from slatecraft.functions.text import SIZE_TIER_ABOVE, SIZE_TIERS, size_tier
from slatecraft.operators.keyed import distinct_on
from slatecraft.operators.reshape import pivot_sum_cells, slot_columns, unpivot_filled
from slatecraft.plans.top_lineups import SINGLE_GAME_SLOTS

POSITIONS = ("QB", "RB", "WR", "TE", "K", "D")
ENTRY_LIMIT = 100


def large_contests(
    contests: DataFrame, size_categories: Sequence[str], entry_limit: int, tiers=SIZE_TIERS, above: str = SIZE_TIER_ABOVE
) -> DataFrame:
    """Ids of large contests that allow many entries."""
    large = size_tier(F.col("contest_size"), tiers, above).isin(*size_categories)
    return contests.filter(large & (F.col("multi_entry_max") >= entry_limit)).select("contest_id")


def entered(
    user_lineups: DataFrame,
    contests: DataFrame,
    user: str | None,
    size_categories: Sequence[str],
    entry_limit: int,
    tiers=SIZE_TIERS,
    above: str = SIZE_TIER_ABOVE,
) -> DataFrame:
    """Entries of one user, or of all, in large contests that allow many entries."""
    wanted = large_contests(contests, size_categories, entry_limit, tiers, above)
    entries = user_lineups if user is None else user_lineups.filter(F.col("user_id") == user)
    return entries.join(wanted, "contest_id")


def exposure(
    user_lineups: DataFrame,
    contests: DataFrame,
    lineups: DataFrame,
    players: DataFrame,
    user: str | None = None,
    slots: Sequence[str] = SINGLE_GAME_SLOTS,
    captain: str = "cpt1",
    positions: Sequence[str] = POSITIONS,
    size_categories: Sequence[str] = (SIZE_TIER_ABOVE,),
    entry_limit: int = ENTRY_LIMIT,
) -> DataFrame:
    """One row per user and contest: salary and ownership range, largest use of one player in any
    slot and as captain, and how captains spread over positions.

    Shares divide by the number of entries, whatever their multiplicity.
    """
    entries = entered(user_lineups, contests, user, size_categories, entry_limit)
    key = ["user_id", "contest_id"]
    entry_counts = entries.groupBy(*key).agg(F.count("lineup_hash").alias("entries"))
    columns = slot_columns(slots)
    # line-ups of other contests go before the rest is made distinct
    own = lineups.join(large_contests(contests, size_categories, entry_limit), "contest_id", "left_semi")
    full = entries.select(*key, "lineup_hash").distinct().join(
        distinct_on(
            own.select("contest_id", "lineup_hash", "date_id", "total_salary", "total_own", *columns),
            ["contest_id", "lineup_hash"],
        ),
        ["contest_id", "lineup_hash"],
    )
    ranges = full.groupBy(*key).agg(
        F.min("total_salary").alias("min_salary"),
        F.max("total_salary").alias("max_salary"),
        F.min("total_own").alias("min_own"),
        F.max("total_own").alias("max_own"),
    )
    cells = unpivot_filled(full, [*key, "date_id"], columns, "slot", "player_id")
    known = distinct_on(players.select("player_id", "date_id", "position"), ["player_id", "date_id"])
    is_captain = F.col("slot") == f"pos_{captain}"
    used = (
        cells.join(known.hint("merge"), ["player_id", "date_id"])  # as in top_lineups: never a table for the driver
        .groupBy(*key, "player_id", "position")
        .agg(F.count(F.lit(1)).alias("used"), F.sum(F.when(is_captain, 1)).alias("captained"))
        .join(entry_counts, key)
        .withColumn("use", ratio(F.col("used"), F.col("entries")))
        .withColumn("captain_use", ratio(F.col("captained"), F.col("entries")))
    )
    shares = used.groupBy(*key).agg(
        F.max("use").alias("max_used_count_percent"),
        F.max("captain_use").alias("max_cpt_usage_percent"),
        *pivot_sum_cells(
            F.col("position"), positions, F.col("captain_use"), "position_usage_on_cpt_percent"
        ),
    )
    return ranges.join(shares.filter(F.col("max_cpt_usage_percent").isNotNull()), key)
