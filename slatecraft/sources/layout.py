"""Where tables lie and how to read them.

Landed files use plain folders ``<layer>/<sport>/<table>/<game type>/<date>/data.*``; tables written
by the jobs use Hive folders (``sport=.../game_type=.../date=...``), so a date filter prunes files.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecraft.functions.dates import path_part

PARTITION = ["sport", "game_type", "date"]


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().toString() for s in status] if status is not None else []


def matching(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """The patterns that match at least one path; any Hadoop file system."""
    return [p for p in patterns if _listed(spark, p)]


def folders(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """All paths the patterns match."""
    return [path for p in patterns for path in _listed(spark, p)]


def month_patterns(start: str | None, end: str | None) -> list[str]:
    """Date folders by month, ``2025-02-*``; all folders unless both ends are given."""
    if not start or not end:
        return ["*"]
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{m // 12}-{m % 12 + 1:02d}-*" for m in months]


def month_bounds(start: str | None, end: str | None) -> tuple[str, str] | None:
    """First and last day, as texts, of the months from one date to another; none unless both are given."""
    if not start or not end:
        return None
    return f"{date.fromisoformat(start):%Y-%m}-01", f"{date.fromisoformat(end):%Y-%m}-31"


def read_or_empty(
    spark: SparkSession,
    patterns: Sequence[str],
    schema: T.StructType | str,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Rows of the existing paths, or an empty frame of the schema."""
    existing = matching(spark, patterns)
    if not existing:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**options).format(fmt).load(existing)


def read_merged(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """Parquet files whose columns differ, united by column name."""
    return spark.read.option("mergeSchema", "true").parquet(*patterns)


def with_path_columns(df: DataFrame, typed: bool = True) -> DataFrame:
    """``date``, ``game_type`` (and ``sport``) from the plain folder layout, counted from the end."""
    path = F.col("_metadata.file_path")
    added = df.select("*", path.alias("_path"))
    day = path_part(F.col("_path"), -2)
    game_type = path_part(F.col("_path"), -3)
    sport = path_part(F.col("_path"), -5)
    added = added.withColumn("date", day)
    if typed:
        added = added.withColumn("game_type", game_type).withColumn("sport", sport)
    return added.drop("_path")


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A table written by the jobs; with a declared schema no footer is read, and missing columns are null."""
    if schema is not None:
        return spark.read.schema(schema).parquet(f"{root}/{table}")
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/{table}")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
