"""Wide to long and back, for line-up slots and other fixed column groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slot_columns(slots: Sequence[str]) -> list[str]:
    return [f"pos_{s}" for s in slots]


def unpivot_slots(
    lineups: DataFrame,
    keep: Sequence[str],
    slots: Sequence[str],
    name: str = "pos_slot",
    value: str = "player_id",
) -> DataFrame:
    """One row per line-up and slot; empty slots stay as null."""
    pairs = F.array(
        *[F.struct(F.lit(s).alias(name), F.col(f"pos_{s}").alias(value)) for s in slots]
    )
    return lineups.select(*keep, F.inline(pairs))


def unpivot_attributes(
    wide: DataFrame,
    keep: Sequence[str],
    slots: Sequence[str],
    attributes: Mapping[str, str],
    name: str = "position_slot",
) -> DataFrame:
    """Several parallel attributes per slot; ``attributes`` maps output name to column suffix."""
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias(name),
                *[F.col(f"pos_{s}_{suffix}").alias(out) for out, suffix in attributes.items()],
            )
            for s in slots
        ]
    )
    return wide.select(*keep, F.inline(rows))


def unpivot_filled(
    wide: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Unpivot that leaves out empty cells."""
    return wide.unpivot(list(keep), list(columns), name, value).dropna(subset=[value])


def pivot_cells(
    slot: Column, slots: Sequence[str], attributes: Mapping[str, Column]
) -> list[Column]:
    """Aggregates for long-to-wide: the largest value of each attribute per slot."""
    return [
        F.max(F.when(slot == F.lit(s), column)).alias(f"pos_{s}_{suffix}")
        for s in slots
        for suffix, column in attributes.items()
    ]


def pivot_sum_cells(name: Column, values: Sequence[str], value: Column, suffix: str) -> list[Column]:
    """Aggregates for a pivot by sum: one column ``<NAME>_<suffix>`` for each of the given names."""
    return [F.sum(F.when(name == F.lit(v), value)).alias(f"{v}_{suffix}") for v in values]


def explode_map(df: DataFrame, keep: Sequence[str], entries: Column, key: str, value: str) -> DataFrame:
    """One row per map entry; rows with an empty or missing map disappear."""
    return df.select(*keep, F.explode(entries).alias(key, value))


def with_slots(df: DataFrame, players: str, slots: Sequence[str]) -> DataFrame:
    """Replaces a map of slot to player id by ``pos_*`` columns; keys compare without case, the last of equal ones counts."""
    names = F.reverse(F.transform(F.map_keys(players), F.lower))
    listed = df.withColumns({"_names": names, "_ids": F.reverse(F.map_values(players))}).drop(players)
    cells = {f"pos_{s}": F.get("_ids", F.array_position("_names", F.lit(s)).cast("int") - 1) for s in slots}
    return listed.withColumns(cells).drop("_names", "_ids")


def slot_names(lineups: DataFrame, players: str) -> list[str]:
    """All slot names that occur, lower case and sorted: a list of a dozen names at most."""
    names = lineups.select(F.explode(F.map_keys(players)).alias("slot"))
    found = names.select(F.lower("slot").alias("slot")).distinct().orderBy("slot")
    return [r["slot"] for r in found.collect()]
