"""Names, positions, tiers and codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
DEFENCE_CODES = ("DEF", "DST", "D")
DEFENCE = "DST"
SIZE_TIERS = ((318, "1_Tiny"), (4444, "2_Small"), (16646, "3_Medium"), (79270, "4_Large"))
SIZE_TIER_ABOVE = "5_Massive"
SLATE_TYPES = {3: "fd_classic", 4: "dk_classic", 8: "dk_single_game", 9: "fd_anyflex", 11: "yh_classic"}
NORMALISED_SLATE_TYPES = ("dk_classic", "dk_single_game")
SPORT_IDS = {"NFL": 1, "NBA": 2, "NHL": 4}
ODDS_LEAGUES = {"NFL": "football/nfl", "NBA": "basketball/nba", "NHL": "hockey/nhl", "MLB": "baseball/mlb"}
LINE_TEAM_CODES = {"CBJ": "CLB", "LAK": "LA", "NSH": "NAS", "SJS": "SJ", "TBL": "TB", "WSH": "WAS"}
WINGS = ("LW", "RW")
WING = "W"
# ----------------------------------------------------------------------------------------------


def strip_first_digit(text: Column) -> Column:
    """Drop one digit only: ``WR1`` -> ``WR``, ``WR12`` -> ``WR2``."""
    return F.regexp_replace(text, r"^([^0-9]*)[0-9]", "$1")


def normalise_position(raw: Column) -> Column:
    return F.when(F.upper(raw).isin(*DEFENCE_CODES), F.lit(DEFENCE)).otherwise(
        F.upper(strip_first_digit(raw))
    )


def merge_wings(position: Column) -> Column:
    return F.when(position.isin(*WINGS), F.lit(WING)).otherwise(position)


def tier(
    value: Column, steps: Sequence[tuple[float, str]], above: str, inclusive: bool = True
) -> Column:
    """First step whose bound covers the value; unknown values land in the last tier."""
    chosen = F
    for bound, label in steps:
        chosen = chosen.when(value <= bound if inclusive else value < bound, F.lit(label))
    return chosen.otherwise(F.lit(above))


def size_tier(size: Column, steps=SIZE_TIERS, above: str = SIZE_TIER_ABOVE) -> Column:
    return tier(size, steps, above)


def lookup(key: Column, table: Mapping) -> Column:
    """Value of a small fixed table, null for an unknown key."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(literal, key)


def recode(key: Column, table: Mapping) -> Column:
    """Like :func:`lookup`, but unknown keys stay as they are."""
    return F.coalesce(lookup(key, table), key)


def name_parts(names: Column, separator: str = "-") -> Column:
    return F.split(names, separator)


def clean_name(name: Column) -> Column:
    return F.trim(F.upper(name))


def name_within(full: Column, part: Column) -> Column:
    """``full LIKE '%' || part || '%'`` with ``part`` read as a pattern.

    A part without pattern characters, as names are, is searched as plain bytes; no pattern is compiled for it.
    """
    is_pattern = F.contains(part, F.lit("%")) | F.contains(part, F.lit("_")) | F.contains(part, F.lit("\\"))
    return F.when(is_pattern, F.like(full, F.concat(F.lit("%"), part, F.lit("%")))).otherwise(F.contains(full, part))
