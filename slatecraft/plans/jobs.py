"""Jobs: landed documents of all unfinished dates to tables, and tables to marts.

One run handles every date that is due, for all game types, in one Spark job per table, replaces
the partitions of these dates and only then records them in the ledger. A run that fails leaves the
ledger as it was, and the next one does the same dates again. Documents that are no JSON, or hold a field of
another type, give no rows; their texts are written aside and their dates stay out of the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecraft.functions.dates import date_id, path_part, previous_month
from slatecraft.functions.text import NORMALISED_SLATE_TYPES
from slatecraft.operators.reshape import slot_names
from slatecraft.plans import correlations, min_points, normalise, team_stacks, top_users
from slatecraft.plans.top_lineups import LineupConfig, top_lineups
from slatecraft.session import shared_folder
from slatecraft.sources import ledger, schemas
from slatecraft.sources.layout import PARTITION, folders, month_bounds, read_table
from slatecraft.sources.raw import DAMAGED, read_lines
from slatecraft.sources.sinks import replace_partitions, write_mart, write_payload, write_reports

SETTLE_DAYS = 5


@dataclass(frozen=True)
class TableJob:
    """Where the raw rows of a table lie, their schema and how to normalise them."""

    source: str
    schema: object
    normalise: Callable[[DataFrame], DataFrame]
    by_game_type: bool = True
    #: What ``normalise`` gives, if it runs jobs on the way.
    shape: Callable[[DataFrame], DataFrame] | None = None

    def stored_schema(self, spark: SparkSession, slots: Sequence[str] = ()) -> T.StructType:
        """Columns of the table the job writes, folder columns last; worked out without reading anything."""
        keys = PARTITION if self.by_game_type else [c for c in PARTITION if c != "game_type"]
        raw = T.StructType([*self.schema.fields, *[T.StructField(c, T.StringType()) for c in keys]])
        made = (self.shape or self.normalise)(spark.createDataFrame([], raw)).schema
        own = [f for f in made.fields if f.name not in PARTITION]
        cells = [T.StructField(f"pos_{s}", T.IntegerType()) for s in slots]
        return T.StructType([*own, *cells, *[T.StructField(c, T.StringType()) for c in PARTITION]])


def _lineups(raw: DataFrame) -> DataFrame:
    """Line-ups are parsed once and written; their slots come from what was written."""
    folder = shared_folder(raw.sparkSession, "lineups")
    normalise.placed_lineups(raw).write.parquet(folder)
    placed = raw.sparkSession.read.parquet(folder)
    return normalise.last_landed(placed, slot_names(placed, "_players"))


TABLES = {
    "contests": TableJob("contests", schemas.CONTESTS_RAW, normalise.contests),
    "players": TableJob("contest_analyze", schemas.CONTEST_ANALYZE_RAW, normalise.players),
    "users": TableJob("contest_analyze", schemas.CONTEST_ANALYZE_RAW, normalise.users),
    "user_lineups": TableJob("contest_analyze", schemas.CONTEST_ANALYZE_RAW, normalise.user_lineups),
    "lineups": TableJob("lineups", schemas.LINEUPS_RAW, _lineups, shape=lambda raw: normalise.lineups(raw, ())),
    "draft_groups": TableJob("draft_groups", schemas.DRAFT_GROUPS_RAW, normalise.draft_groups, False),
}


def _pattern(root: str, sport: str, job: TableJob, day: str = "*") -> list[str]:
    base = f"{root}/{sport}/{job.source}"
    if not job.by_game_type:
        return [f"{base}/{day}"]
    return [f"{base}/{game_type}/{day}" for game_type in NORMALISED_SLATE_TYPES]


def landed_dates(spark: SparkSession, root: str, sport: str, table: str) -> DataFrame:
    """Dates with landed files, one row each."""
    found = folders(spark, _pattern(root, sport, TABLES[table]))
    days = sorted({path.rstrip("/").rsplit("/", 1)[-1] for path in found})
    rows = [("dds", sport, table, day) for day in days]
    return spark.createDataFrame(rows, schemas.LEDGER)


def read_landed(spark: SparkSession, paths: Sequence[str], job: TableJob) -> DataFrame:
    """Raw rows with sport, game type and date taken from the folders, and the text of damaged ones."""
    raw = read_lines(spark, list(paths), job.schema, damaged=True).select("*", F.col("_metadata.file_path").alias("_path"))
    columns = {"date": path_part(F.col("_path"), -2)}
    if job.by_game_type:
        columns |= {"game_type": path_part(F.col("_path"), -3), "sport": path_part(F.col("_path"), -5)}
    else:
        columns |= {"sport": path_part(F.col("_path"), -4)}
    return raw.withColumns(columns).drop("_path")


def store_landed(spark: SparkSession, paths: Sequence[str], job: TableJob, out: str, table: str) -> dict[str, int]:
    """Replaces the partitions of all dates in the paths; returns the damaged documents by date.

    They are counted in the pass that normalises the others, and read once more only if there are any: then
    ``<out>/_damaged/<table>`` gets their texts.
    """
    raw = read_landed(spark, paths, job)
    seen = Observation()
    harmed = F.col(DAMAGED).isNotNull()
    counts = [F.count_if(harmed).alias("documents"), F.collect_set(F.when(harmed, F.col("date"))).alias("days")]
    replace_partitions(job.normalise(raw.observe(seen, *counts).filter(~harmed).drop(DAMAGED)), f"{out}/{table}")
    # the reader tells damage only if other fields are read as well
    missing = sum((F.col(f.name).isNull().cast("int") for f in job.schema.fields), F.lit(0)).alias("missing")
    try:
        damage = seen.get
    except Py4JJavaError:  # adaptive execution drops the counters with the plan of an empty result
        damage = raw.select("date", DAMAGED, missing).agg(*counts, F.sum("missing")).first().asDict()
    if not damage["documents"]:
        return {}
    keys = [c for c in PARTITION if c in raw.columns]
    aside = f"{out}/_damaged/{table}"
    again = raw.filter(F.col("date").isin(*damage["days"]))
    texts = again.select(F.col(DAMAGED).alias("text"), missing, *keys).filter("text IS NOT NULL")
    replace_partitions(texts, aside, keys)
    found = spark.read.parquet(aside).withColumn("date", F.col("date").cast("string"))
    counted = found.filter(F.col("date").isin(*damage["days"])).groupBy("date").count()
    return {r["date"]: r["count"] for r in counted.collect()}  # a row per date


def normalise_pending(
    spark: SparkSession,
    landed: str,
    out: str,
    ledger_path: str,
    sport: str,
    table: str,
    run_date: str,
    lag_days: int = SETTLE_DAYS,
) -> list[str]:
    """Normalise all settled dates that are not in the ledger yet; returns those without damaged documents."""
    job = TABLES[table]
    due = ledger.settled(landed_dates(spark, landed, sport, table), F.lit(run_date).cast("date"), lag_days)
    todo = ledger.pending(due, ledger.read_ledger(spark, ledger_path))
    days = sorted(r["date"] for r in todo.select("date").collect())  # dates only, a few thousand at most
    if not days:
        return []
    paths = folders(spark, [p for day in days for p in _pattern(landed, sport, job, day)])
    damaged = store_landed(spark, paths, job, out, table)
    whole = [day for day in days if day not in damaged]
    if whole:
        ledger.mark(spark, ledger_path, spark.createDataFrame([("dds", sport, table, day) for day in whole], schemas.LEDGER))
    return whole


def _of(
    spark: SparkSession,
    root: str,
    table: str,
    sport: str,
    game_type: str | None = None,
    days: tuple[str, str] | None = None,
    slots: Sequence[str] = (),
) -> DataFrame:
    """Rows of a table by folder: of a sport, a game type, and from one day to another.

    The columns are declared, so no file is opened to learn them, and folders outside are never listed as input.
    """
    rows = read_table(spark, root, table, TABLES[table].stored_schema(spark, slots)).filter(F.col("sport") == sport)
    rows = rows.filter(F.col("game_type") == game_type) if game_type else rows
    return rows.filter(F.col("date").between(*days)) if days else rows


def top_lineups_job(spark: SparkSession, tables: str, marts: str, config: LineupConfig) -> None:
    lineups = _of(spark, tables, "lineups", config.sport, config.game_type, slots=config.slots).withColumn("date_id", date_id(F.col("date")))
    players = _of(spark, tables, "players", config.sport, config.game_type).withColumn("date_id", date_id(F.col("date")))
    write_mart(top_lineups(lineups, players, config), f"{marts}/{config.output}")


def team_stacks_job(spark: SparkSession, marts: str, config: LineupConfig) -> None:
    mart = spark.read.parquet(f"{marts}/{config.output}")
    reports = team_stacks.all_reports(mart, config.slots)
    write_reports(reports, f"{marts}/team_stacks/{config.sport}/{config.game_type}")


def top_users_job(spark: SparkSession, tables: str, marts: str, sport: str) -> None:
    contests = _of(spark, tables, "contests", sport).withColumnRenamed("game_type", "slate_type")
    mart = top_users.top_users(_of(spark, tables, "users", sport), contests)
    write_mart(top_users.ordered_top_users(mart), f"{marts}/top_users/{sport}")


def position_correlations_job(spark: SparkSession, tables: str, marts: str, sport: str) -> None:
    mart = correlations.position_correlations(_of(spark, tables, "players", sport))
    write_mart(correlations.strongest_first(mart), f"{marts}/position_correlations/{sport}")


def line_correlations_job(spark: SparkSession, tables: str, marts: str, lines: str, sport: str = "NHL") -> None:
    players = _of(spark, tables, "players", sport).withColumn("game_date", F.col("date"))
    mart = correlations.line_correlations(players, spark.read.parquet(lines))
    write_mart(correlations.strongest_first(mart), f"{marts}/line_correlations/{sport}")


def lines_job(spark: SparkSession, landed: str, out: str) -> bool:
    """Lines of all landed days; false when there are none."""
    found = folders(spark, [f"{landed}/players/*"])
    if not found:
        return False
    stats = spark.read.parquet(*found).select("*", F.col("_metadata.file_path").alias("_path"))
    write_mart(normalise.lines(stats.withColumn("game_date", path_part(F.col("_path"), -2))), out)
    return True


def min_points_between(
    spark: SparkSession, tables: str, sport: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Points per slate; with both ends only the folders of their months are read, of all three tables."""
    days = month_bounds(start, end)
    return min_points.min_points(
        _of(spark, tables, "contests", sport, days=days),
        _of(spark, tables, "lineups", sport, days=days),
        _of(spark, tables, "draft_groups", sport, days=days),
        start,
        end,
    )


def min_points_job(
    spark: SparkSession, tables: str, out: str, sport: str, start: str | None = None, end: str | None = None
) -> dict:
    """Points per slate in a date range (none: all time), written as an export; returns the summary."""
    result = min_points_between(spark, tables, sport, start, end)
    path = f"{out}/min_points/{sport}"
    write_mart(result, f"{path}/table")
    stored = spark.read.parquet(f"{path}/table")
    write_payload(min_points.payload_header(stored, sport, start, end), min_points.payload_rows(stored), path)
    return min_points.run_summary(stored).first().asDict()


def last_month(spark: SparkSession, today: str) -> tuple[str, str]:
    """First and last day of the month before ``today``, as ISO texts."""
    first, last = previous_month(F.lit(today).cast("date"))
    row = spark.range(1).select(first.cast("string").alias("a"), last.cast("string").alias("b")).first()
    return row["a"], row["b"]
