"""Writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from slatecraft.plans.normalise import with_load_time
from slatecraft.sources.layout import PARTITION


def write_mart(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: Sequence[str] = PARTITION) -> None:
    """Replace only the partitions that occur in ``df``; the others stay untouched.

    Rows meet by partition before the write, so that a date is a few files instead of one per task;
    adaptive execution splits dates that are too large for one task.
    """
    (
        df.hint("rebalance", *partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition)
        .parquet(path)
    )


def write_landed(df: DataFrame, path: str) -> None:
    """Raw rows as gzip JSON lines, stamped with the load time."""
    with_load_time(df).write.mode("overwrite").option("compression", "gzip").json(path)


def write_nested(df: DataFrame, path: str) -> None:
    """Raw rows as Parquet, nested types kept."""
    with_load_time(df).write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A catalog table from a query, replaced as a whole, its rows dealt to buckets by key.

    Each bucket is one file, so tables of the same key and number of buckets join without moving rows. The files lie in
    ``path``; the catalog only names them.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def write_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    """Several outputs of one job."""
    for name, df in reports.items():
        write_mart(df, f"{root}/{name}")


def write_payload(header: DataFrame, rows: DataFrame, path: str) -> None:
    """Export: a one-line header and the records as JSON lines."""
    header.write.mode("overwrite").json(f"{path}/header")
    rows.write.mode("overwrite").text(f"{path}/data")
