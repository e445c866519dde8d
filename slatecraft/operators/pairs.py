"""Moments over all pairs of entities met in one event, without building the pairs.

A pair is two rows of one event, ordered by entity id. Its statistics are needed per (class of the
first, class of the second, same team or not). Rows of one event, id, team and class are summed up
first. For what is left it is enough to know, per class and team of its event, the moments of the rows with a smaller
id: running sums in a window. The work is rows times classes (a few dozen, for the two teams of an event)
instead of rows times rows.

An event may hold any share of the table. In events of more than ``2**bits`` rows, counted first, ids are
cut into ranges of ``2**bits``: first come pairs inside one range of one event, then the ranges are summed up and
compared with each other one level higher, and so on. All other events are one range. No window partition holds
more ids than one range has, and rows of ordinary events move once.

Moments are kept as counts, sums and sums of squares of distances from the approximate median of the row's
class, so merging them is adding. An outlier moves no median: large values close to each other keep their spread
beside values far away, of their own class or another. What is lost in a cell is the part 1e-16 * ((mean of the cell -
median of the class) / deviation of the cell) ** 2. Whether a side has any spread is told by its extremes, not by the
rounding of sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.session import shared_folder

SAME = "same_team"
OPPONENT = "opponent_team"
BITS = 16
#: Medians of at most so many classes are broadcast; more are joined.
MANY_CLASSES = 10_000
#: Rows of the input to a partition of events; each is repeated for every class and team of its event and then sorted.
ROWS_PER_PARTITION = 100_000

_SUMS = ("n", "known", "total", "squares")
_PAIR = ["cls_1", "cls_2", "team_relationship"]


def _levels(low: int | None, high: int | None, bits: int) -> list[int]:
    """Bits of each level up to one range that covers all ids."""
    span = (high - low).bit_length() if low is not None else 0
    return list(range(0, max(span, 1), bits))


def _medians(ids: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Per class its median value, rows and range of ids, written once: a row per class."""
    folder = shared_folder(ids.sparkSession, "medians")
    ids.groupBy(*classes).agg(
        F.coalesce(F.percentile_approx("_value", 0.5, 1000), F.lit(0.0)).alias("_median"),
        F.min("_id").alias("_low"),
        F.max("_id").alias("_high"),
        F.count(F.lit(1)).alias("_rows"),
    ).write.parquet(folder)
    return ids.sparkSession.read.parquet(folder)


def _large_events(rows: DataFrame, event: str, bits: int) -> tuple[DataFrame, int]:
    """Events of more rows than one range has, written once, and their number: at most one for ``2**bits`` rows."""
    folder = shared_folder(rows.sparkSession, "events")
    counted = rows.filter(F.col(event).isNotNull()).groupBy(F.col(event).alias("event")).agg(F.count(F.lit(1)).alias("_rows"))
    counted.filter(F.col("_rows") > 2**bits).select("event").write.parquet(folder)
    found = rows.sparkSession.read.parquet(folder)
    number = found.count()
    return F.broadcast(found) if number <= MANY_CLASSES else found, number


def _summed(rows: DataFrame) -> DataFrame:
    """Moments by event, id, team and class: an id that repeats in an event is one row from here on."""
    value = F.col("value")
    return rows.groupBy("event", "id", "team", "cls").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count(value).cast("double").alias("known"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(value * value), F.lit(0.0)).alias("squares"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def _widened(atoms: DataFrame, bits: int) -> DataFrame:
    """The same for ranges of ids."""
    return atoms.groupBy("event", F.shiftright("id", bits).alias("id"), "team", "cls").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("low").alias("low"), F.max("high").alias("high")
    )


def _inside_ranges(ranged: DataFrame, partitions: int) -> DataFrame:
    """Moments for the pairs whose ids share a range (or an event, where there are none) but differ at this level."""
    groups = [c for c in ("event", "_range") if c in ranged.columns]
    ranged = ranged.repartition(partitions, *groups)
    sides = F.collect_set(F.struct("cls", "team")).over(Window.partitionBy(*groups))
    placed = ranged.withColumn("_sides", sides).withColumn(
        "_own", F.array_position("_sides", F.struct("cls", "team")) - 1
    )
    grid = placed.select(
        *groups, "id", "team", "cls", "_own", *_SUMS, "low", "high", F.posexplode("_sides").alias("_side", "first")
    )
    before = (
        Window.partitionBy(*groups, "_side").orderBy("id").rangeBetween(Window.unboundedPreceding, -1)
    )
    mine = F.col("_own") == F.col("_side")
    pairs = grid.select(
        F.col("first.cls").alias("cls_1"),
        F.col("cls").alias("cls_2"),
        F.when(F.col("team") == F.col("first.team"), SAME).otherwise(OPPONENT).alias("team_relationship"),
        *_SUMS, "low", "high",
        *[F.sum(F.when(mine, F.col(c)).otherwise(F.lit(0.0))).over(before).alias(f"f_{c}") for c in _SUMS],
        F.min(F.when(mine, F.col("low"))).over(before).alias("f_low"),
        F.max(F.when(mine, F.col("high"))).over(before).alias("f_high"),
    ).filter(F.col("f_n") > 0)
    product = lambda first, second: F.sum(F.col(f"f_{first}") * F.col(second))
    first, second = F.col("f_known") > 0, F.col("known") > 0
    return pairs.groupBy(*_PAIR).agg(
        product("n", "n").alias("pairs"),
        product("known", "known").alias("both"),
        product("total", "known").alias("sum_1"),
        product("known", "total").alias("sum_2"),
        product("squares", "known").alias("squares_1"),
        product("known", "squares").alias("squares_2"),
        product("total", "total").alias("cross"),
        product("known", "n").alias("known_1"),
        product("total", "n").alias("all_1"),
        product("squares", "n").alias("all_squares_1"),
        product("n", "known").alias("known_2"),
        product("n", "total").alias("all_2"),
        product("n", "squares").alias("all_squares_2"),
        F.min(F.when(second, F.col("f_low"))).alias("low_1"),
        F.max(F.when(second, F.col("f_high"))).alias("high_1"),
        F.min(F.when(first, F.col("low"))).alias("low_2"),
        F.max(F.when(first, F.col("high"))).alias("high_2"),
        F.min("f_low").alias("all_low_1"),
        F.max("f_high").alias("all_high_1"),
        F.min("low").alias("all_low_2"),
        F.max("high").alias("all_high_2"),
    )


def _moment(n: str, total: str, squares: str, low: str, high: str) -> Column:
    """Squared deviations from the mean; exactly zero where all values are the same."""
    raw = F.col(squares) - F.try_divide(F.col(total) * F.col(total), F.col(n))
    return F.when(F.col(low) == F.col(high), F.lit(0.0)).otherwise(F.greatest(raw, F.lit(0.0)))


def pair_moments(
    rows: DataFrame,
    event: str,
    entity: str,
    team: str,
    classes: Sequence[str],
    value: Column,
    bits: int = BITS,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Moments over all pairs, per class of the first, class of the second and team relationship.

    Class columns come back as ``<name>_1`` and ``<name>_2``. ``pairs`` counts all, ``both`` those with two known
    values, whose means, squared deviations and products are ``mean_i``, ``m2_i`` and ``products``; ``known_i``,
    ``all_mean_i`` and ``all_m2_i`` cover the pairs where side i is known. Counts are exact up to 2**53. Medians and the
    range of ids are looked up first; ``ids`` may name a cheaper frame that covers all ids and has like values and some
    of the classes, and if it names events, all rows of each (or more).
    """
    listed = rows if ids is None else ids
    known = [c for c in classes if c in listed.columns]
    identified = listed.select(*known, F.col(entity).cast("long").alias("_id"), value.cast("double").alias("_value"))
    medians = _medians(identified, known)
    low, high, found_classes, n = medians.agg(F.min("_low"), F.max("_high"), F.count(F.lit(1)), F.sum("_rows")).first()
    partitions = max(8, (n or 0) // ROWS_PER_PARTITION)
    medians = medians.select(*[F.col(c).alias(f"_of_{c}") for c in known], "_median")
    # few dozens as a rule; rows are not dealt by class, as one class may hold most of them
    medians = F.broadcast(medians) if found_classes <= MANY_CLASSES else medians
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in known] or [F.lit(True)]
    median = F.coalesce("_median", F.lit(0.0))
    off = value.cast("double") - median
    measured = rows.filter(F.col(event).isNotNull() & F.col(entity).isNotNull()).join(medians, same, "left").select(
        F.col(event).alias("event"),
        F.col(entity).cast("long").alias("id"),
        F.col(team).alias("team"),
        F.struct(*[F.col(c).alias(c) for c in classes], median.alias("_median")).alias("cls"),
        off.alias("value"),
    )
    # ids keep their name and value up to here: rows dealt by entity, event and team are summed where they lie
    atoms = _summed(measured).withColumn("id", F.col("id") - F.lit(low or 0))
    large, number = _large_events(listed if event in listed.columns else rows, event, bits)
    if not number:
        found = _inside_ranges(atoms, partitions)
    else:
        ranged = atoms.join(large.withColumn("_large", F.lit(True)), "event", "left")
        ranged = ranged.withColumn("_range", F.when(F.col("_large"), F.shiftright("id", bits)).otherwise(F.lit(-1)))
        found = _inside_ranges(ranged, partitions)
        atoms = atoms.join(large, "event", "left_semi")
        for _ in _levels(low, high, bits)[1:]:
            atoms = _widened(atoms, bits)
            found = found.unionByName(_inside_ranges(atoms.withColumn("_range", F.shiftright("id", bits)), partitions))
    ends = {c: F.min if "low" in c else F.max for c in found.columns if "low" in c or "high" in c}
    measures = [c for c in found.columns if c not in _PAIR]
    found = found.groupBy(*_PAIR).agg(*[ends.get(c, F.sum)(c).alias(c) for c in measures])
    c = F.col
    return found.select(
        *[F.col(f"cls_{i}.{k}").alias(f"{k}_{i}") for i in (1, 2) for k in classes],
        "team_relationship", "pairs", "both", "known_1", "known_2",
        *[(F.try_divide(f"sum_{i}", "both") + c(f"cls_{i}._median")).alias(f"mean_{i}") for i in (1, 2)],
        *[_moment("both", f"sum_{i}", f"squares_{i}", f"low_{i}", f"high_{i}").alias(f"m2_{i}") for i in (1, 2)],
        (c("cross") - F.try_divide(c("sum_1") * c("sum_2"), c("both"))).alias("products"),
        *[(F.try_divide(f"all_{i}", f"known_{i}") + c(f"cls_{i}._median")).alias(f"all_mean_{i}") for i in (1, 2)],
        *[_moment(f"known_{i}", f"all_{i}", f"all_squares_{i}", f"all_low_{i}", f"all_high_{i}").alias(f"all_m2_{i}") for i in (1, 2)],
    )
