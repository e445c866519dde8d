"""Best line-ups of each contest with the details of the player in every slot."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.operators.keyed import player_role, slot_role
from slatecraft.operators.reshape import pivot_cells, slot_columns, unpivot_slots


@dataclass(frozen=True)
class LineupConfig:
    """Slots of a game type, the share of best line-ups to keep and slots with a special role."""

    sport: str
    game_type: str
    slots: tuple[str, ...]
    output: str
    threshold: float = 0.01
    roles: Mapping[str, str] = field(default_factory=dict)
    complete_only: bool = False

    def __post_init__(self) -> None:
        for name in ("sport", "game_type", "slots", "output"):
            if not getattr(self, name):
                raise ValueError(f"{name} must not be empty")
        if not 0 < self.threshold <= 1:
            raise ValueError("threshold must lie in (0, 1]")


# --- fixed values -----------------------------------------------------------------------------
SINGLE_GAME_SLOTS = ("cpt1", "flex1", "flex2", "flex3", "flex4", "flex5")
CLASSIC_SLOTS = ("dst1", "flex1", "qb1", "rb1", "rb2", "te1", "wr1", "wr2", "wr3")
CAPTAIN_ROLE = {"cpt1": "CPT"}
# ----------------------------------------------------------------------------------------------


def _single_game(sport: str) -> LineupConfig:
    return LineupConfig(
        sport, "dk_single_game", SINGLE_GAME_SLOTS, f"top_lineups/{sport}/dk_single_game", roles=CAPTAIN_ROLE
    )


PRESETS = {
    "nfl_single_game": _single_game("NFL"),
    "nba_single_game": _single_game("NBA"),
    "nhl_single_game": _single_game("NHL"),
    "nfl_classic": LineupConfig(
        "NFL", "dk_classic", CLASSIC_SLOTS, "top_lineups/NFL/dk_classic", complete_only=True
    ),
}


def top_lineups(
    lineups: DataFrame, players: DataFrame, config: LineupConfig, key: str = "lineup_rank"
) -> DataFrame:
    """One row per contest and rank, with id, position, team and salary of the player in each slot.

    Slots become rows, meet the players in one equi join and are put back with one aggregate whose
    map side already folds the rows of a line-up into one. Line-ups tied at a rank share a row
    unless ``key`` is a column that tells them apart, such as ``lineup_hash``.
    """
    best = lineups.filter(F.col("lineup_percentile") <= config.threshold)
    if config.complete_only:
        best = best.dropna(how="any", subset=slot_columns(config.slots))
    keep = list(dict.fromkeys(["date_id", "contest_id", "lineup_rank", key, "total_own", "total_salary"]))
    cells = unpivot_slots(best, keep, config.slots).withColumn(
        "role", slot_role(F.col("pos_slot"), config.roles)
    )
    roster = players.select(
        "date_id",
        "player_id",
        player_role(F.col("roster_position"), config.roles).alias("role"),
        "position",
        "current_team",
        "salary",
    )
    # merged, not broadcast: players made by exploding slates are far more than their files let expect
    joined = cells.join(roster.hint("merge"), ["date_id", "player_id", "role"])
    attributes = {
        "player_id": F.col("player_id"),
        "real": F.col("position"),
        "team": F.col("current_team"),
        "salary": F.col("salary"),
    }
    totals = [F.max(c).alias(c) for c in ("total_own", "total_salary")]
    if key != "lineup_rank":
        totals.insert(0, F.max("lineup_rank").alias("lineup_rank"))
    return joined.groupBy("contest_id", key).agg(
        *totals, *pivot_cells(F.col("pos_slot"), config.slots, attributes)
    )


def top_lineups_short(lineups: DataFrame, players: DataFrame, config: LineupConfig) -> DataFrame:
    """The older layout of the single-game mart: three columns per slot, without the player id."""
    wide = top_lineups(lineups, players, config)
    return wide.drop(*[f"pos_{s}_player_id" for s in config.slots])
