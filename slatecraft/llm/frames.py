"""What the corpus operators share: reading, row keys, and tables that cut lineage."""

from __future__ import annotations

import functools
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="corpus-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the one that driver and executors share (``spark.checkpoint.dir``).

    In local mode, where the setting may be missing, a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there: evaluated once, safe from lost executors."""
    folder = shared_folder(frame.sparkSession)
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def bucketed(frame: DataFrame, key: str, buckets: int) -> DataFrame:
    """As ``written``, in buckets by a key: grouped or joined by it, the rows are read where they are needed and not moved."""
    spark, name = frame.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").option("path", shared_folder(spark)).bucketBy(buckets, key).saveAsTable(name)
    table = spark.table(name)
    table.schema  # looked up now; the name goes, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table


#: Rows of a narrow table that one task writes.
ROWS_PER_FILE = 250_000


def few_files(frame: DataFrame, rows: float) -> DataFrame:
    """A narrow frame of at most so many rows, in as many partitions as these fill."""
    return frame.coalesce(max(1, math.ceil(rows / ROWS_PER_FILE)))


def row_key(*columns: Column) -> Column:
    """128 bits for the values of some columns; null differs from every text. Equal rows share a key."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts += [F.coalesce(F.octet_length(text).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat_ws("\x1f", *parts))


def unused(frame: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, lengthened until no column of the frame has them in any case."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
