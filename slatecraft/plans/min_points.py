"""Points needed to finish in the money, per slate."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.dates import within_ids
from slatecraft.operators.keyed import descending, top1_per_key

CUTS = {5: Decimal("0.05"), 10: Decimal("0.10"), 15: Decimal("0.15")}
REQUIRED = (
    "slate_id",
    "min_points",
    "max_points",
    *[f"top_{p}_percentile_points" for p in CUTS],
    "max_lineup_rank",
)


def _cut_columns() -> list[Column]:
    return [
        F.ceil(F.col("total_entries") * F.lit(share)).cast("int").alias(f"rank_{p}_percentile")
        for p, share in CUTS.items()
    ]


def rank_cutoffs(lineups: DataFrame) -> DataFrame:
    """Worst rank of each contest and the ranks that close its best 5, 10 and 15 percent."""
    worst = lineups.groupBy("contest_id").agg(F.max("lineup_rank").alias("total_entries"))
    return worst.select("contest_id", "total_entries", *_cut_columns())


def contest_results(lineups: DataFrame) -> DataFrame:
    """Points in the money and at the cut-offs per contest, reading the line-ups twice.

    One aggregate finds everything that needs no cut-off; the second pass keeps the ranks up to the
    widest cut-off, and the last rank so that no contest gets lost.
    """
    slim = lineups.select("contest_id", "lineup_rank", "points", "is_cashing")
    cashed = lambda c: F.when(F.col("is_cashing"), F.col(c))
    known = slim.groupBy("contest_id").agg(
        F.max("lineup_rank").alias("total_entries"),
        F.min(cashed("points")).alias("min_points"),
        F.max(cashed("points")).alias("max_points"),
        F.max(cashed("lineup_rank")).alias("max_lineup_rank"),
    )
    ranked = slim.drop("is_cashing").join(known.select("*", *_cut_columns()), "contest_id")
    last = F.col("lineup_rank").eqNullSafe(F.col("total_entries"))
    carried = ("min_points", "max_points", "max_lineup_rank")
    return (
        ranked.filter((F.col("lineup_rank") <= F.col(_WIDEST)) | last)
        .groupBy("contest_id")
        .agg(*[F.max(c).alias(c) for c in carried], *_points_at())
    )


def points_at_cutoffs(lineups: DataFrame) -> DataFrame:
    """Points at the greatest rank not beyond each cut-off; the smallest where ranks tie."""
    ranked = lineups.select("contest_id", "lineup_rank", "points").join(rank_cutoffs(lineups), "contest_id")
    return ranked.filter(F.col("lineup_rank") <= F.col(_WIDEST)).groupBy("contest_id").agg(*_points_at())


_WIDEST = f"rank_{max(CUTS)}_percentile"


def _points_at() -> list[Column]:
    def at(cut: str) -> Column:
        usable = F.col("points").isNotNull() & (F.col("lineup_rank") <= F.col(cut))
        return F.max_by("points", F.when(usable, F.struct("lineup_rank", (-F.col("points")).alias("p"))))

    return [at(f"rank_{p}_percentile").alias(f"top_{p}_percentile_points") for p in CUTS]


def points_at_exact_rank(lineups: DataFrame) -> DataFrame:
    """Earlier form: points of the line-ups exactly at each cut-off rank."""
    ranked = lineups.select("contest_id", "lineup_rank", "points").join(rank_cutoffs(lineups), "contest_id")
    at = {p: F.col("lineup_rank") == F.col(f"rank_{p}_percentile") for p in CUTS}
    some = None
    for test in at.values():
        some = test if some is None else some | test
    return (
        ranked.filter(some)
        .groupBy("contest_id")
        .agg(*[F.max(F.when(t, F.col("points"))).alias(f"top_{p}_percentile_points") for p, t in at.items()])
    )


def cashing_points(lineups: DataFrame) -> DataFrame:
    """Lowest and highest points and the worst rank among the line-ups in the money."""
    return (
        lineups.filter(F.col("is_cashing"))
        .groupBy("contest_id")
        .agg(
            F.min("points").alias("min_points"),
            F.max("points").alias("max_points"),
            F.max("lineup_rank").alias("max_lineup_rank"),
        )
    )


def _largest(contests: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return contests.filter(F.col("is_largest_by_size") & within_ids(F.col("date_id"), start, end)).select(
        "contest_id", F.col("contest_group_id").alias("draft_group_id"), "cash_line", "date_id"
    )


def _slates(draft_groups: DataFrame) -> DataFrame:
    """Made distinct before the join, so that repeated draft groups do not multiply contests."""
    return draft_groups.select(
        "draft_group_id", F.col("draft_group_reference_id").alias("slate_id")
    ).distinct()


def contest_points(
    contests: DataFrame,
    lineups: DataFrame,
    draft_groups: DataFrame,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One row per slate and largest contest, before any choice between them."""
    largest = _largest(contests, start, end)
    wanted = lineups.join(largest.select("contest_id").distinct(), "contest_id", "left_semi")
    return (
        largest.join(contest_results(wanted), "contest_id", "left")
        .join(_slates(draft_groups), "draft_group_id")
        .select(
            "slate_id",
            "contest_id",
            "date_id",
            "min_points",
            "max_points",
            *[f"top_{p}_percentile_points" for p in CUTS],
            "cash_line",
            "max_lineup_rank",
        )
        .distinct()
    )


def min_points(
    contests: DataFrame,
    lineups: DataFrame,
    draft_groups: DataFrame,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One complete row per slate, from its contest with the most line-ups in the money.

    Ties go to the smallest contest id. A slate whose chosen contest lacks a value is left out.
    """
    rows = contest_points(contests, lineups, draft_groups, start, end)
    order = [*descending(F.col("max_lineup_rank")), F.col("contest_id")]
    chosen = top1_per_key(rows, ["slate_id"], order)
    return chosen.dropna(how="any", subset=list(REQUIRED)).drop("contest_id", "date_id")


def min_points_first_version(contests: DataFrame, lineups: DataFrame, draft_groups: DataFrame) -> DataFrame:
    """Without cut-offs: lowest points in the money and worst such rank per largest contest."""
    cashing = cashing_points(lineups).select("contest_id", F.col("min_points").alias("points"), "max_lineup_rank")
    return (
        _largest(contests, None, None)
        .join(cashing, "contest_id", "left")
        .join(_slates(draft_groups), "draft_group_id")
        .select("slate_id", "contest_id", "points", "max_lineup_rank")
        .distinct()
    )


def newest_first(rows: DataFrame) -> DataFrame:
    """Sort by a column that does not stay in the result."""
    return rows.orderBy(F.desc_nulls_last("date_id"), "slate_id", "contest_id").drop("date_id")


def run_summary(result: DataFrame) -> DataFrame:
    """Counts and status of one run."""
    return result.agg(
        F.count(F.lit(1)).alias("total_records"), F.count("min_points").alias("records_with_min_points")
    ).withColumn("status", F.when(F.col("total_records") > 0, "success").otherwise("no_data"))


def payload_header(result: DataFrame, sport: str, start: str | None, end: str | None) -> DataFrame:
    """Head of the export: what it covers and how many rows follow."""
    return result.agg(
        F.count(F.lit(1)).alias("total_records"), F.count("min_points").alias("records_with_min_points")
    ).select(
        F.lit(sport).alias("sport"),
        F.lit(start).cast("string").alias("start_date"),
        F.lit(end).cast("string").alias("end_date"),
        "total_records",
        "records_with_min_points",
    )


def payload_rows(result: DataFrame) -> DataFrame:
    """Each record of the export as one JSON text."""
    return result.select(F.to_json(F.struct(*result.columns)).alias("record"))


def truncated_ranks(rows: DataFrame) -> DataFrame:
    """Preview of cut-off ranks by cutting off decimals, unlike the rounding up used for results."""
    return rows.select(
        "*", *[F.floor(F.col("max_lineup_rank") * F.lit(float(s))).alias(f"rank_{p}pct") for p, s in CUTS.items()]
    )
