"""Stacks of team mates in the best line-ups: sizes, teams, patterns around a quarterback or defence.

The input is the top line-ups mart, one row per contest and rank. Positions and stacks are worked
out inside each row; the only shuffles are those of the final aggregates, whose groups are few and
which combine on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.numeric import ratio, round_to
from slatecraft.functions.stacks import (
    has_teammate,
    sizes_descending,
    slot_entries,
    stack_combinations,
    stacks,
    team_of,
    with_repeats,
)
from slatecraft.functions.text import DEFENCE, normalise_position
from slatecraft.operators.reshape import unpivot_attributes
from slatecraft.operators.shares import over_all, share_of
from slatecraft.plans.top_lineups import CLASSIC_SLOTS
from slatecraft.session import shared_folder

# --- fixed values -----------------------------------------------------------------------------
ANCHOR = "QB"
PARTNERS = ("WR", "TE", "RB")
NOT_STACKED = "QB not stacked"
# ----------------------------------------------------------------------------------------------

_LINEUP = ["contest_id", "lineup_rank", "total_own"]


def positions_long(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> DataFrame:
    """One row per line-up and slot with the team and position of its player."""
    attributes = {"team": "team", "position_raw": "real"}
    return unpivot_attributes(mart, [*_LINEUP, "total_salary"], slots, attributes)


def positions_normalised(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> DataFrame:
    """The same for slots with a known team, with one spelling per position."""
    return (
        positions_long(mart, slots)
        .filter(F.col("team").isNotNull())
        .withColumn("position_normalized", normalise_position(F.col("position_raw")))
    )


def _with_stacks(mart: DataFrame, slots: Sequence[str]) -> DataFrame:
    if "stacks" in mart.columns:
        return mart
    return _with_entries(mart, slots).withColumn("stacks", stacks(F.col("entries")))


def _with_entries(mart: DataFrame, slots: Sequence[str]) -> DataFrame:
    return mart if "entries" in mart.columns else mart.select(*_LINEUP, slot_entries(slots).alias("entries"))


def team_counts(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> DataFrame:
    """Teams with two or more players in a line-up."""
    return _with_stacks(mart, slots).select(*_LINEUP, F.inline("stacks"))


def _known_lineup() -> Column:
    return F.count_if(F.col("contest_id").isNotNull() & F.col("lineup_rank").isNotNull())


def _averages(weight: Column) -> list[Column]:
    def mean(name: str) -> Column:
        value = F.col(name)
        return ratio(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))

    return [
        round_to(mean("total_own"), 2).alias("avg_total_own"),
        round_to(mean("lineup_rank"), 1).alias("avg_lineup_rank"),
    ]


def _sums() -> list[Column]:
    return [
        F.sum("total_own").alias("own"),
        F.count("total_own").alias("own_n"),
        F.sum("lineup_rank").alias("rank"),
        F.count("lineup_rank").alias("rank_n"),
    ]


def _averages_of_sums() -> list[Column]:
    return [
        round_to(ratio(F.sum("own"), F.sum("own_n")), 2).alias("avg_total_own"),
        round_to(ratio(F.sum("rank"), F.sum("rank_n")), 1).alias("avg_lineup_rank"),
    ]


def stack_sizes(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> DataFrame:
    """How often each combination of stack sizes occurs.

    A combination that repeats within a line-up counts once, but weighs with its repeats in the
    averages. A row without a combination per line-up carries the total along, in the same pass.
    """
    combos = with_repeats(stack_combinations(sizes_descending(F.col("stacks"))))
    marked = F.concat(combos, F.array(F.struct(F.lit(None).cast("string").alias("item"), F.lit(1).alias("times"))))
    rows = _with_stacks(mart, slots).select(*_LINEUP, F.inline(marked))
    counted = rows.groupBy(F.col("item").alias("stack_combination")).agg(
        _known_lineup().alias("lineup_count"), *_averages(F.col("times"))
    )
    total = over_all(F.max(F.when(F.col("stack_combination").isNull(), F.col("lineup_count"))))
    return (
        counted.withColumn("pct_of_lineups", share_of("lineup_count", total))
        .filter(F.col("stack_combination").isNotNull())
        .select("stack_combination", "lineup_count", "pct_of_lineups", "avg_total_own", "avg_lineup_rank")
    )


def team_details(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> DataFrame:
    """Stacks per team and size, with the position combination seen most often.

    Combinations are counted first; a second, small aggregate sums them up and picks the largest
    (ties: the first by name). A row without a team per line-up carries the total along.
    """
    nothing = F.struct(
        F.lit(None).cast("string").alias("team"),
        F.lit(0).cast("long").alias("stack_size"),
        F.lit(None).cast("string").alias("position_combo"),
    )
    rows = _with_stacks(mart, slots).select(*_LINEUP, F.inline(F.concat("stacks", F.array(nothing))))
    by_combo = rows.groupBy("team", "stack_size", "position_combo").agg(
        F.count(F.lit(1)).alias("n"), _known_lineup().alias("known"), *_sums()
    )
    best = F.min_by(
        F.struct("position_combo", "n"), F.struct(-F.col("n"), F.col("position_combo").isNull(), "position_combo")
    )
    total = over_all(F.max(F.when(F.col("team").isNull(), F.col("known"))))
    return (
        by_combo.groupBy("team", "stack_size")
        .agg(
            F.sum("n").alias("lineup_count"),
            F.sum("known").alias("known"),
            best.alias("best"),
            *_averages_of_sums(),
        )
        .withColumn("pct_of_lineups", share_of("lineup_count", total))
        .filter(F.col("team").isNotNull())
        .select(
            "team",
            "stack_size",
            "lineup_count",
            "pct_of_lineups",
            F.col("best.position_combo").alias("position_combo"),
            F.col("best.n").alias("position_combo_count"),
            "avg_total_own",
            "avg_lineup_rank",
        )
    )


def _class_of(wr: Column, te: Column, rb: Column, strict: bool) -> Column:
    """Which partners share the anchor's team; the first fitting class wins.

    With ``strict`` a running back next to pass catchers makes a class of its own, which the plain
    order of tests never reaches.
    """
    chosen = F.when(rb & (wr | te), "QB + RB + pass catchers") if strict else F
    return (
        chosen.when(wr & te, "QB + WR + TE")
        .when(wr, "QB + WR (no TE)")
        .when(te, "QB + TE (no WR)")
        .when(rb, "QB + RB (no pass catchers)")
        .otherwise(NOT_STACKED)
    )


def anchor_patterns(
    mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS, strict: bool = False
) -> DataFrame:
    """Who is stacked with the quarterback; shares refer to the line-ups that stack at all."""
    entries = F.col("entries")
    teamed = (
        _with_entries(mart, slots)
        .withColumn("qb_team", team_of(entries, ANCHOR))
        .filter(F.col("qb_team").isNotNull())
    )
    wr, te, rb = (has_teammate(entries, p, F.col("qb_team")) for p in PARTNERS)
    counted = (
        teamed.select(*_LINEUP, _class_of(wr, te, rb, strict).alias("stack_type"))
        .groupBy("stack_type")
        .agg(F.count(F.lit(1)).alias("lineup_count"), *_averages(F.lit(1)))
    )
    stacked = over_all(F.sum(F.when(F.col("stack_type") != NOT_STACKED, F.col("lineup_count")).otherwise(0)))
    return counted.withColumn("pct_of_qb_stacks", share_of("lineup_count", stacked)).select(
        "stack_type", "lineup_count", "pct_of_qb_stacks", "avg_total_own", "avg_lineup_rank"
    )


def defence_patterns(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> DataFrame:
    """Is the defence part of a stack, and with which positions most often (shown on every row)."""
    teamed = (
        _with_stacks(mart, slots)
        .withColumn("dst_team", team_of(F.col("entries"), DEFENCE))
        .filter(F.col("dst_team").isNotNull())
    )
    mine = F.filter("stacks", lambda s: s["team"] == F.col("dst_team"))
    marked = teamed.select(*_LINEUP, F.get(mine, F.lit(0)).alias("own")).select(
        *_LINEUP, F.col("own").isNotNull().alias("dst_in_stack"), F.col("own.position_combo").alias("position_combo")
    )
    by_combo = marked.groupBy("dst_in_stack", "position_combo").agg(F.count(F.lit(1)).alias("n"), *_sums())
    most = F.min_by(
        F.struct("position_combo", "n"), F.struct(-F.col("n"), F.col("position_combo").isNull(), "position_combo")
    )
    rows = by_combo.groupBy("dst_in_stack").agg(
        F.sum("n").alias("lineup_count"), most.alias("most"), *_averages_of_sums()
    )
    best = over_all(F.max(F.when(F.col("dst_in_stack"), F.col("most"))))
    return rows.select(
        "dst_in_stack",
        "lineup_count",
        share_of("lineup_count", over_all(F.sum("lineup_count"))).alias("pct_of_lineups"),
        best["position_combo"].alias("most_common_position_combo"),
        best["n"].alias("combo_count"),
        "avg_total_own",
        "avg_lineup_rank",
    )


def all_reports(mart: DataFrame, slots: Sequence[str] = CLASSIC_SLOTS) -> dict[str, DataFrame]:
    """The four outputs by table name.

    The slots of a line-up are read and stacked once and written with its rank and ownership; the outputs come from
    these narrow rows.
    """
    folder = shared_folder(mart.sparkSession, "stacks")
    _with_stacks(mart, slots).write.parquet(folder)
    stacked = mart.sparkSession.read.parquet(folder)
    return {
        "stack_sizes": stack_sizes(stacked),
        "team_details": team_details(stacked),
        "qb_patterns": anchor_patterns(stacked),
        "dst_patterns": defence_patterns(stacked),
    }
