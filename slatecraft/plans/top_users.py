"""Results of users by slate type and contest size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.numeric import ratio, round_to
from slatecraft.functions.text import SIZE_TIER_ABOVE, SIZE_TIERS, size_tier

PERCENTILES = (1, 2, 5, 10, 20, 50)


def top_users(
    users: DataFrame, contests: DataFrame, tiers=SIZE_TIERS, above: str = SIZE_TIER_ABOVE
) -> DataFrame:
    """One row per user, slate type and size tier; ``contests`` carries ``slate_type``."""
    sized = contests.select(
        "contest_id", "slate_type", size_tier(F.col("contest_size"), tiers, above).alias("size_category")
    )
    return (
        users.join(sized, "contest_id")
        .groupBy("user_id", "slate_type", "size_category")
        .agg(
            round_to(ratio(F.sum("unique_rosters"), F.sum("total_rosters")), 2).alias("unique_roster_percent"),
            round_to(F.avg("max_exposure"), 2).alias("avg_max_exposure"),
            F.sum("lineups_cashing").alias("total_lineups_cashing"),
            *[
                F.sum(f"lineups_in_percentile_{p}").alias(f"total_lineups_in_percentile_{p}")
                for p in PERCENTILES
            ],
            round_to(F.sum("total_entry_cost"), 2).alias("total_entry_cost"),
            round_to(F.sum("total_winning"), 2).alias("total_winning"),
            round_to(F.sum("roi"), 2).alias("roi"),
        )
    )


def ordered_top_users(mart: DataFrame) -> DataFrame:
    return mart.orderBy("slate_type", "size_category", F.desc_nulls_last("roi"))
