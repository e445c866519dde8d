"""Team stacks inside one line-up row.

A line-up is one row with a handful of slots, so everything about its stacks is worked out inside
the row with array functions; no shuffle is needed before the final, small aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatecraft.functions.text import normalise_position


def slot_entries(slots: Sequence[str]) -> Column:
    """``array<struct<slot, team, position>>`` of the filled slots (team known)."""
    entries = F.array(
        *[
            F.struct(
                F.lit(s).alias("slot"),
                F.col(f"pos_{s}_team").alias("team"),
                F.col(f"pos_{s}_real").alias("position_raw"),
                normalise_position(F.col(f"pos_{s}_real")).alias("position"),
            )
            for s in slots
        ]
    )
    return F.filter(entries, lambda e: e["team"].isNotNull())


def _combo(members: Column) -> Column:
    positions = F.array_compact(F.array_distinct(F.transform(members, lambda e: e["position"])))
    # a list of one, so that the positions are worked out once
    return F.transform(
        F.array(positions), lambda p: F.when(F.size(p) > 0, F.array_join(F.array_sort(p), ","))
    )[0]


def stacks(entries: Column, smallest: int = 2) -> Column:
    """``array<struct<team, stack_size, position_combo>>`` for teams with several players."""
    teams = F.array_distinct(F.transform(entries, lambda e: e["team"]))
    members = F.transform(teams, lambda t: F.filter(entries, lambda e: e["team"] == t))
    return F.transform(
        F.filter(members, lambda m: F.size(m) >= smallest),
        lambda m: F.struct(
            m[0]["team"].alias("team"),
            F.size(m).cast("long").alias("stack_size"),
            _combo(m).alias("position_combo"),
        ),
    )


def sizes_descending(found: Column) -> Column:
    return F.sort_array(F.transform(found, lambda s: s["stack_size"]), asc=False)


def joined(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: x.cast("string")), ",")


def proper_prefixes(items: Column) -> Column:
    """``[4,3,2]`` -> ``[[4],[4,3]]``; nothing for lists of one item or none."""
    lengths = F.filter(F.sequence(F.lit(0), F.size(items) - 1), lambda n: n >= 1)
    prefixes = F.transform(lengths, lambda n: F.slice(items, F.lit(1), n))
    return F.when(F.size(items) > 1, prefixes).otherwise(F.filter(prefixes, lambda p: F.lit(False)))


def stack_combinations(sizes: Column) -> Column:
    """All combination texts of one line-up, with repeats.

    The full list counts once per stack, then come its proper prefixes and each single size:
    ``[4,3,2]`` gives ``4,3,2`` three times, ``4``, ``4,3``, and ``4``, ``3``, ``2``.
    """
    return F.concat(
        F.array_repeat(joined(sizes), F.size(sizes)),
        F.transform(proper_prefixes(sizes), joined),
        F.transform(sizes, lambda x: x.cast("string")),
    )


def with_repeats(items: Column) -> Column:
    """``array<struct<item, times>>``: each distinct item with its number of occurrences."""
    return F.transform(
        F.array_distinct(items),
        lambda x: F.struct(
            x.alias("item"), F.size(F.filter(items, lambda y: y == x)).alias("times")
        ),
    )


def team_of(entries: Column, position: str) -> Column:
    """Team (largest name when several) of the players at one position; null without one."""
    return F.array_max(
        F.transform(F.filter(entries, lambda e: e["position"] == position), lambda e: e["team"])
    )


def has_teammate(entries: Column, position: str, team: Column) -> Column:
    return F.exists(
        entries, lambda e: F.coalesce((e["position"] == position) & (e["team"] == team), F.lit(False))
    )
