"""Normalise newly landed files with Structured Streaming.

The stream's checkpoint remembers which files were read, in place of the ledger. A batch tells which
dates have new files; these dates are then read as a whole and replaced, so a file that lands late
adds to its date. Game types are those of the ledger jobs. Damaged documents
are written aside, as there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slatecraft.functions.text import NORMALISED_SLATE_TYPES
from slatecraft.plans.jobs import TABLES, store_landed


def normalise_new_files(
    spark: SparkSession, landed: str, sport: str, table: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Replace the partitions of all dates that have files not seen before, and stop.

    A batch that is repeated after a failure writes the same partitions again. ``checkpoint`` lies on
    shared storage.
    """
    job = TABLES[table]
    game_types = f"{{{','.join(NORMALISED_SLATE_TYPES)}}}/" if job.by_game_type else ""
    arrived = (
        spark.readStream.schema(job.schema)
        .json(f"{landed}/{sport}/{job.source}/{game_types}*")
        .select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
    )

    def write(batch: DataFrame, _: int) -> None:
        folders = [row["folder"] for row in batch.distinct().collect()]  # a row per date and game type
        if folders:
            store_landed(batch.sparkSession, folders, job, out, table)

    return (
        arrived.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
