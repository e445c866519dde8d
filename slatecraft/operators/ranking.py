"""Ranks and n-tiles without sorting a partition key, or the whole table, in one task.

Values are counted first, so ties collapse. The distinct values are cut into ordered blocks at
approximate quantiles; a running sum inside each block plus the total of the blocks before it gives
the number of rows ahead of every value. The quantiles only steer the block sizes and have no
influence on the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.session import shared_folder


def _block_count(df: DataFrame, blocks: int | None) -> int:
    """A few blocks per shuffle partition, unless a number is given."""
    if blocks is None:
        blocks = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, blocks)


def _cuts(df: DataFrame, value: str, blocks: int) -> list[float]:
    probabilities = [i / blocks for i in range(1, blocks)]
    return sorted(set(df.approxQuantile(value, probabilities, 0.25 / blocks)))


def _below(points: Column, value: Column) -> Column:
    return F.size(F.filter(points, lambda c: c < value))


def _block(value: Column, cuts: Sequence[float]) -> Column:
    """Number of cut points below the value; missing values come last.

    The cut points are looked up in two steps, groups first, to keep the comparisons few.
    """
    if not cuts:
        return F.when(value.isNull(), 1).otherwise(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    number = value.cast("double")
    full = _below(F.array(*[F.lit(g[-1]) for g in groups]), number)
    listed = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])
    rest = F.when(full < len(groups), _below(F.get(listed, full), number)).otherwise(0)
    # all groups before the last hold `width` cut points
    below = F.when(full < len(groups), full * width + rest).otherwise(len(cuts))
    return F.when(value.isNull(), len(cuts) + 1).otherwise(below)


def running_counts(
    df: DataFrame, value: str, keys: Sequence[str] = (), descending: bool = False, blocks: int | None = None
) -> DataFrame:
    """One row per key and distinct value: ``n`` rows have it and ``before`` rows come ahead of it."""
    keys = list(keys)
    cuts = _cuts(df, value, _block_count(df, blocks))
    counts = (
        df.groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_block", _block(F.col(value), cuts))
    )
    if descending:
        last = len(cuts) + 1
        counts = counts.withColumn(
            "_block", F.when(F.col(value).isNull(), last).otherwise(F.lit(last - 1) - F.col("_block"))
        )
    ahead = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_block")
    offsets = (
        counts.groupBy(*keys, "_block")
        .agg(F.sum("n").alias("_n"))
        .withColumn("_offset", F.sum("_n").over(ahead) - F.col("_n"))
        .drop("_n")
    )
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    local = counts.withColumn("_local", F.sum("n").over(inside) - F.col("n"))
    joined = local.join(
        offsets.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, "_block"]], "_offset"),
        on=[F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in [*keys, "_block"]],
    )
    return joined.select(
        *keys, value, "n", (F.col("_offset") + F.col("_local")).alias("before")
    )


def add_rank(
    df: DataFrame, value: str, keys: Sequence[str], name: str, descending: bool = True, blocks: int | None = None
) -> DataFrame:
    """SQL ``RANK()`` per key; the rows themselves are only joined, never sorted by key."""
    ranks = running_counts(df, value, keys, descending, blocks).select(
        *[F.col(c).alias(f"_r_{c}") for c in [*keys, value]],
        (F.col("before") + 1).alias(name),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in [*keys, value]]
    return df.join(ranks, same).select(*df.columns, name)


def ntile_summary(df: DataFrame, value: str, tiles: int, blocks: int | None = None) -> DataFrame:
    """Rows, smallest, largest and mean value of each of ``tiles`` equal buckets of sorted rows.

    The first ``total % tiles`` buckets hold one row more. A value whose rows straddle a border is
    split by count, which is all that a summary of the buckets can see.
    """
    counts = running_counts(df, value, (), False, blocks)
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    ranged = counts.withColumn("_total", total).withColumn(
        "bucket", F.explode(F.sequence(F.lit(1), F.lit(tiles)))
    )
    small = F.expr(f"_total div {tiles}")
    extra = F.col("_total") % tiles
    start = (F.col("bucket") - 1) * small + F.least(F.col("bucket") - 1, extra)
    end = F.col("bucket") * small + F.least(F.col("bucket"), extra)
    shared = F.least(F.col("before") + F.col("n"), end) - F.greatest(F.col("before"), start)
    known = F.col(value).isNotNull()
    return (
        ranged.withColumn("_rows", shared)
        .filter(F.col("_rows") > 0)
        .groupBy("bucket")
        .agg(
            F.sum("_rows").alias("n"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.try_divide(
                F.sum(F.col("_rows") * F.col(value)), F.sum(F.when(known, F.col("_rows")))
            ).alias("avg_value"),
        )
    )


def add_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with their place in the whole order, from 1, as ``name``.

    Rows are dealt to ranges of the order and written once; rows before a range are added from one count per
    range. Sampling the borders reads ``df`` once more, so it should be a stored table. Rows that are equal in
    all of ``order`` share a range and follow each other in any order.
    """
    taken = set(df.columns)
    range_, n, ahead, place = (next(c for c in (k + "_" * i for i in range(len(taken) + 1)) if c not in taken) for k in ("_range", "_n", "_ahead", "_place"))
    folder = shared_folder(df.sparkSession, "ordered")
    df.repartitionByRange(*order).withColumn(range_, F.spark_partition_id()).write.parquet(folder)
    stored = df.sparkSession.read.parquet(folder)
    before = Window.partitionBy(F.lit(0)).orderBy(range_)  # a row per range
    ranges = stored.groupBy(range_).agg(F.count(F.lit(1)).alias(n))
    offsets = ranges.select(range_, (F.sum(n).over(before) - F.col(n)).alias(ahead))
    inside = Window.partitionBy(range_).orderBy(*order)
    numbered = stored.withColumn(place, F.row_number().over(inside).cast("long")).join(offsets, range_)
    return numbered.select(*df.columns, (F.col(ahead) + F.col(place)).alias(name))
