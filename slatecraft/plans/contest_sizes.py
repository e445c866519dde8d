"""Contests in equal buckets by size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.numeric import round_to
from slatecraft.operators.ranking import ntile_summary


def size_quintiles(contests: DataFrame, tiles: int = 5) -> DataFrame:
    buckets = ntile_summary(contests.select("contest_size"), "contest_size", tiles)
    return buckets.select(
        F.col("bucket").alias("size_bucket"),
        F.col("n").alias("contest_count"),
        F.col("min_value").alias("min_size"),
        F.col("max_value").alias("max_size"),
        round_to(F.col("avg_value"), 0).alias("avg_size"),
    )
