"""Ledger of finished dates (pipeline, sport, table_name, date): a log of numbered entries.

A run adds one entry, a small file of JSON lines with the next number. It is written aside and renamed only if no
other has that number, so of two runs at once one comes second, sees what the first marked, and tries again with
what is left. Now and then all entries are summed up in one file; readers take the newest sum and what follows. A
ledger holds a row per date and table, a few thousands, which go through the driver when they are marked.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slatecraft.sources.schemas import LEDGER

KEY = ["pipeline", "sport", "table_name", "date"]
#: Entries after which they are summed up.
SUM_AFTER = 20
_TRIES = 100
_NAME = re.compile(r"(\d{10})(\.sum)?\.json")


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = fs.Path(path)
    return fs, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the entries and of the sums that are there."""
    _, where, files = _hadoop(spark, path)
    found = [_NAME.fullmatch(s.getPath().getName()) for s in files.listStatus(where)] if files.exists(where) else []
    matched = [m for m in found if m]
    return sorted(int(m[1]) for m in matched if not m[2]), sorted(int(m[1]) for m in matched if m[2])


def _read(spark: SparkSession, path: str, entries: Sequence[int], sums: Sequence[int]) -> DataFrame:
    upto = max(sums, default=0)
    names = [f"{path}/{upto:010d}.sum.json"] * bool(sums) + [f"{path}/{n:010d}.json" for n in entries if n > upto]
    return spark.read.schema(LEDGER).json(names) if names else spark.createDataFrame([], LEDGER)


def _create(spark: SparkSession, path: str, name: str, rows: Sequence) -> bool:
    """Writes a file under a name that nobody has yet; false if somebody has."""
    fs, where, files = _hadoop(spark, path)
    aside = fs.Path(where, f".{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write("".join(json.dumps(r.asDict()) + "\n" for r in rows).encode())
    out.close()
    gateway = spark.sparkContext._gateway
    never_over = gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(fs.Path(where, name)), never_over)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Finished dates; none when the ledger does not exist yet."""
    return _read(spark, path, *_numbers(spark, path))


def pending(candidates: DataFrame, done: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Candidates that are not in the ledger."""
    return candidates.join(done.select(*keys), list(keys), "left_anti")


def settled(candidates: DataFrame, run_date: Column, lag_days: int, day: str = "date") -> DataFrame:
    """Candidates old enough that late data has arrived; names that are no dates are left out."""
    return candidates.filter(F.col(day).try_cast("date") <= F.date_sub(run_date, lag_days))


def pending_or_today(
    candidates: DataFrame, done: DataFrame, today: Column, keys: Sequence[str] = KEY, day: str = "date"
) -> DataFrame:
    """Unfinished candidates, and today's ones even when finished."""
    marked = candidates.join(
        done.select(*keys).distinct().withColumn("_done", F.lit(True)), list(keys), "left"
    )
    wanted = (F.col(day).try_cast("date") == today) | F.col("_done").isNull()
    return marked.filter(wanted).drop("_done")


def mark(spark: SparkSession, path: str, finished: DataFrame) -> None:
    """Add dates that are not yet in the ledger, sorted, as one entry; marking twice changes nothing."""
    wanted = finished.select(*KEY).distinct()
    for _ in range(_TRIES):
        entries, sums = _numbers(spark, path)
        fresh = pending(wanted, _read(spark, path, entries, sums)).orderBy(*KEY).collect()
        if not fresh:
            return
        last = max([*entries, *sums], default=0)
        if _create(spark, path, f"{last + 1:010d}.json", fresh):
            if last + 1 - max(sums, default=0) >= SUM_AFTER:
                sum_up(spark, path)
            return
    raise RuntimeError(f"other runs kept marking {path}")


def sum_up(spark: SparkSession, path: str) -> None:
    """One file in place of all entries so far.

    What the sum before covered is deleted now, and not what this one covers: others may be reading it.
    """
    entries, sums = _numbers(spark, path)
    last = max(entries, default=0)
    if last <= max(sums, default=0):
        return
    _create(spark, path, f"{last:010d}.sum.json", _read(spark, path, entries, sums).orderBy(*KEY).collect())
    fs, where, files = _hadoop(spark, path)
    before = max(sums, default=0)
    for name in [f"{n:010d}.json" for n in entries if n <= before] + [f"{n:010d}.sum.json" for n in sums if n < before]:
        files.delete(fs.Path(where, name), False)
