"""Contest tables derived from the driver's tables, as DataFrames and as SQL.

An order is a line-up, its line items fill the slots, parts are players, and a contest is a group of
customers in one year. Everything except the slots of a line-up is worked out row by row. Measures
are whole numbers held as doubles, so that sums and means do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEARS = (1995, 2001)
STACK_SLOTS = ("qb1", "rb1", "rb2", "wr1", "wr2", "te1", "dst1")
SHORT_SLOTS = ("qb1", "rb1", "wr1")
TOP_SHARE = 0.1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(c) -> "F.Column":
    return F.floor(c).cast("double")


# --- line-ups ---------------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    rank = (F.lit(500001) - F.floor("o_totalprice")).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        ((F.col("o_custkey") % 10) * 100 + (year - YEARS[0])).alias("contest_id"),
        F.concat(F.lit("u"), F.expr("o_custkey div 10").cast("string")).alias("user_id"),
        F.concat(F.lit("h"), F.col("o_orderkey").cast("string")).alias("lineup_hash"),
        (year * 10000 + 101).alias("date_id"),
        rank.alias("lineup_rank"),
        (rank / F.lit(500000.0)).alias("lineup_percentile"),
        (rank / F.lit(500000.0) <= 0.2).alias("is_cashing"),
        whole("o_totalprice").alias("points"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("lineup_ct"),
    )


ORDERS_SQL = f"""
lineup_heads AS (
  SELECT o_orderkey,
         (o_custkey % 10) * 100 + (year(o_orderdate) - {YEARS[0]}) AS contest_id,
         'u' || (o_custkey // 10) AS user_id,
         'h' || o_orderkey AS lineup_hash,
         CAST(year(o_orderdate) * 10000 + 101 AS INTEGER) AS date_id,
         CAST(500001 - floor(o_totalprice) AS INTEGER) AS lineup_rank,
         (500001 - floor(o_totalprice)) / 500000.0::DOUBLE AS lineup_percentile,
         (500001 - floor(o_totalprice)) / 500000.0::DOUBLE <= 0.2::DOUBLE AS is_cashing,
         floor(o_totalprice) AS points,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS lineup_ct
  FROM orders)"""


def lineups(spark: SparkSession, sf_dir: str, slots: Sequence[str]) -> DataFrame:
    """Line-ups with ``pos_*`` columns; slot i is the largest part of line number i."""
    filled = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            *[
                F.max(F.when(F.col("l_linenumber") == i, F.col("l_partkey"))).alias(f"pos_{s}")
                for i, s in enumerate(slots, 1)
            ],
            F.sum("l_quantity").alias("total_own"),
            F.min("l_quantity").alias("min_own"),
            F.max("l_quantity").alias("max_own"),
            F.avg("l_quantity").alias("avg_own"),
            F.sum(F.floor("l_extendedprice")).cast("long").alias("total_salary"),
            F.count(F.lit(1)).alias("correlated_players"),
        )
    )
    heads = _orders(spark, sf_dir).withColumn(
        "payout", F.when(F.col("is_cashing"), F.col("points") / 100.0)
    )
    return heads.join(filled, heads["o_orderkey"] == filled["l_orderkey"]).drop("l_orderkey")


def lineups_sql(slots: Sequence[str]) -> str:
    cells = ",\n         ".join(
        f"max(CASE WHEN l_linenumber = {i} THEN l_partkey END) AS pos_{s}" for i, s in enumerate(slots, 1)
    )
    return f"""{ORDERS_SQL},
lineup_cells AS (
  SELECT l_orderkey,
         {cells},
         sum(l_quantity) AS total_own, min(l_quantity) AS min_own, max(l_quantity) AS max_own,
         avg(l_quantity) AS avg_own, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS total_salary,
         count(*) AS correlated_players
  FROM lineitem GROUP BY l_orderkey),
lineups AS (
  SELECT h.*, CASE WHEN is_cashing THEN points / 100.0::DOUBLE END AS payout, c.* EXCLUDE (l_orderkey)
  FROM lineup_heads h JOIN lineup_cells c ON h.o_orderkey = c.l_orderkey)"""


def user_lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("contest_id", "user_id", "lineup_hash", "lineup_ct")


USER_LINEUPS_SQL = "user_lineups AS (SELECT contest_id, user_id, lineup_hash, lineup_ct FROM lineup_heads)"


def contest_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contest and user of the line-ups."""
    return (
        _orders(spark, sf_dir)
        .groupBy("contest_id", "user_id")
        .agg(
            F.count(F.lit(1)).alias("total_rosters"),
            (F.sum("points") / 10000 - 50).alias("roi"),
        )
    )


CONTEST_USERS_SQL = """
contest_users AS (
  SELECT contest_id, user_id, count(*) AS total_rosters, sum(points) / 10000 - 50 AS roi
  FROM lineup_heads GROUP BY contest_id, user_id)"""


def lineup_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contests of the line-ups; some count as the largest of their slate."""
    total = F.sum("points")
    return (
        _orders(spark, sf_dir)
        .groupBy("contest_id")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            (total % 200000).cast("int").alias("contest_size"),
            (F.count(F.lit(1)) % 200).cast("int").alias("multi_entry_max"),
            F.max("date_id").alias("date_id"),
            F.min("points").cast("int").alias("cash_line"),
        )
        .withColumn("contest_group_id", F.col("contest_id"))
        .withColumn("is_largest_by_size", F.col("contest_size") % 4 != 0)
    )


LINEUP_CONTESTS_SQL = """
contests AS (
  SELECT *, contest_id AS contest_group_id, contest_size % 4 <> 0 AS is_largest_by_size FROM (
    SELECT contest_id, count(*) AS entries,
           CAST(sum(points) % 200000 AS INTEGER) AS contest_size,
           CAST(count(*) % 200 AS INTEGER) AS multi_entry_max,
           max(date_id) AS date_id, CAST(min(points) AS INTEGER) AS cash_line
    FROM lineup_heads GROUP BY contest_id))"""


def draft_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draft group per nation and year; its slate is the region in that year."""
    years = F.explode(F.sequence(F.lit(0), F.lit(YEARS[1] - YEARS[0]))).alias("y")
    return table(spark, sf_dir, "nation").select("*", years).select(
        (F.col("n_nationkey") * 100 + F.col("y")).cast("long").alias("draft_group_id"),
        (F.col("n_regionkey") * 100 + F.col("y")).alias("draft_group_reference_id"),
        (F.col("n_nationkey") % 5).alias("source_id"),
        F.concat(F.lit("source "), (F.col("n_nationkey") % 5).cast("string")).alias("display_name"),
        F.col("n_name").alias("source_name"),
        (F.lit(YEARS[0]) * 10000 + F.col("y") * 10000 + 101).alias("date_id"),
        (F.col("n_nationkey") % 7).alias("game_count"),
        F.concat(F.lit("suffix "), F.col("n_name")).alias("contest_suffix"),
        F.concat((F.lit(YEARS[0]) + F.col("y")).cast("string"), F.lit("-01-01")).alias("contest_start_date"),
    )


DRAFT_GROUPS_SQL = f"""
draft_groups AS (
  SELECT CAST(n_nationkey * 100 + y AS BIGINT) AS draft_group_id,
         CAST(n_regionkey * 100 + y AS INTEGER) AS draft_group_reference_id,
         n_nationkey % 5 AS source_id, 'source ' || (n_nationkey % 5) AS display_name,
         n_name AS source_name, CAST(({YEARS[0]} + y) * 10000 + 101 AS INTEGER) AS date_id,
         n_nationkey % 7 AS game_count, 'suffix ' || n_name AS contest_suffix,
         ({YEARS[0]} + y) || '-01-01' AS contest_start_date
  FROM nation, range({YEARS[1] - YEARS[0] + 1}) t(y))"""


# --- players ----------------------------------------------------------------------------------


def _position(p_type, p_size):
    digit = (p_size % 13).cast("string")
    defence = F.when(p_size % 3 == 0, "DST").when(p_size % 3 == 1, "def").otherwise("D")
    return (
        F.when(p_type == "ECONOMY", F.lit("QB"))
        .when(p_type == "LARGE", F.concat(F.lit("WR"), digit))
        .when(p_type == "MEDIUM", F.lit("te"))
        .when(p_type == "PROMO", F.concat(F.lit("RB"), digit))
        .when(p_type == "SMALL", defence)
        .otherwise(F.lit("K"))
    )


_POSITION_SQL = """CASE p_type WHEN 'ECONOMY' THEN 'QB' WHEN 'LARGE' THEN 'WR' || (p_size % 13)
              WHEN 'MEDIUM' THEN 'te' WHEN 'PROMO' THEN 'RB' || (p_size % 13)
              WHEN 'SMALL' THEN CASE p_size % 3 WHEN 0 THEN 'DST' WHEN 1 THEN 'def' ELSE 'D' END
              ELSE 'K' END"""


def player_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per player."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"),
        F.col("p_name").alias("full_name"),
        _position(F.col("p_type"), F.col("p_size")).alias("position"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("current_team"),
        F.floor("p_retailprice").cast("int").alias("salary"),
        F.col("p_size").cast("double").alias("ownership"),
        whole(F.col("p_retailprice") / 10).alias("actual_points"),
    )


PLAYER_BASE_SQL = f"""
player_base AS (
  SELECT p_partkey AS player_id, p_name AS full_name, {_POSITION_SQL} AS position,
         split_part(p_name, ' ', 1) AS current_team, CAST(floor(p_retailprice) AS INTEGER) AS salary,
         CAST(p_size AS DOUBLE) AS ownership, floor(p_retailprice / 10) AS actual_points
  FROM part)"""


def players(spark: SparkSession, sf_dir: str, captains: bool = False) -> DataFrame:
    """Players of each year's slate; with ``captains`` a second row at one and a half the salary."""
    roles = [("FLEX", 2)] + ([("CPT", 3)] if captains else [])
    role = F.array(*[F.struct(F.lit(n).alias("roster_position"), F.lit(h).alias("halves")) for n, h in roles])
    year = F.explode(F.sequence(F.lit(YEARS[0]), F.lit(YEARS[1]))).alias("y")
    return (
        player_base(spark, sf_dir)
        .select("*", year)
        .select("*", F.inline(role))
        .withColumn("salary", F.expr("(salary + y) * halves div 2").cast("int"))
        .withColumn("date_id", F.col("y") * 10000 + 101)
        .drop("y", "halves")
    )


def players_sql(captains: bool = False) -> str:
    roles = "('FLEX', 2), ('CPT', 3)" if captains else "('FLEX', 2)"
    return f"""{PLAYER_BASE_SQL},
players AS (
  SELECT b.* REPLACE (CAST((salary + y) * halves // 2 AS INTEGER) AS salary), roster_position,
         CAST(y * 10000 + 101 AS INTEGER) AS date_id
  FROM player_base b, range({YEARS[0]}, {YEARS[1] + 1}) t(y), (VALUES {roles}) r(roster_position, halves))"""


# --- entries: orders as user results, customers as contests --------------------------------------

PERCENTILES = (1, 2, 5, 10, 20, 50)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    rosters = (F.floor(F.col("o_totalprice") / 5000) + 1).cast("int")
    cost = whole("o_totalprice")
    winning = F.when(F.col("o_orderstatus") == "F", cost * 2).when(F.col("o_orderstatus") == "P", cost)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("contest_id"),
        F.concat(F.lit("u"), F.expr("o_orderkey div 16").cast("string")).alias("user_id"),
        rosters.alias("total_rosters"),
        F.least(rosters, F.dayofmonth("o_orderdate") + 20).alias("unique_rosters"),
        (cost % 100).alias("max_exposure"),
        F.expr("(cast(floor(o_totalprice / 5000) as int) + 1) div 3").cast("int").alias("lineups_cashing"),
        *[
            F.expr(f"(cast(floor(o_totalprice / 5000) as int) + 1) * {p} div 100")
            .cast("int")
            .alias(f"lineups_in_percentile_{p}")
            for p in PERCENTILES
        ],
        cost.alias("total_entry_cost"),
        F.coalesce(winning, F.lit(0.0)).alias("total_winning"),
        (F.coalesce(winning, F.lit(0.0)) - cost).alias("roi"),
    )


_SHARES_SQL = ",\n         ".join(
    f"CAST(rosters * {p} // 100 AS INTEGER) AS lineups_in_percentile_{p}" for p in PERCENTILES
)
USERS_SQL = f"""
users AS (
  SELECT o_custkey AS contest_id, 'u' || (o_orderkey // 16) AS user_id, rosters AS total_rosters,
         CAST(least(rosters, day(o_orderdate) + 20) AS INTEGER) AS unique_rosters,
         cost % 100 AS max_exposure, CAST(rosters // 3 AS INTEGER) AS lineups_cashing,
         {_SHARES_SQL},
         cost AS total_entry_cost, winning AS total_winning, winning - cost AS roi
  FROM (SELECT *, CAST(floor(o_totalprice / 5000) AS INTEGER) + 1 AS rosters, floor(o_totalprice) AS cost,
               CASE o_orderstatus WHEN 'F' THEN 2 * floor(o_totalprice)
                    WHEN 'P' THEN floor(o_totalprice) ELSE 0.0::DOUBLE END AS winning
        FROM orders))"""


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("contest_id"),
        F.col("c_name").alias("contest_name"),
        F.col("c_mktsegment").alias("slate_type"),
        F.floor(F.abs("c_acctbal") * 10).cast("int").alias("contest_size"),
        (F.col("c_nationkey") * 10).alias("multi_entry_max"),
    )


CONTESTS_SQL = """
contests AS (
  SELECT c_custkey AS contest_id, c_name AS contest_name, c_mktsegment AS slate_type,
         CAST(floor(abs(c_acctbal) * 10) AS INTEGER) AS contest_size,
         CAST(c_nationkey * 10 AS INTEGER) AS multi_entry_max
  FROM customer)"""

# fixed values: borders and names of the size tiers
TIER_SQL = """CASE WHEN contest_size <= 318 THEN '1_Tiny' WHEN contest_size <= 4444 THEN '2_Small'
       WHEN contest_size <= 16646 THEN '3_Medium' WHEN contest_size <= 79270 THEN '4_Large'
       ELSE '5_Massive' END"""


# --- performances: line items as players in events -----------------------------------------------

TEAM_CODES = ("CBJ", "LAK", "NSH", "SJS", "TBL", "WSH", "BOS", "NYR")
PLAYED_CODES = ("CLB", "LA", "NAS", "SJ", "TB", "WAS", "BOS", "NYR")


def _code(number, codes: Sequence[str]):
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (number % len(codes) + 1).cast("int"))


def _code_sql(number: str, codes: Sequence[str]) -> str:
    listed = ", ".join(f"'{c}'" for c in codes)
    return f"list_extract([{listed}], CAST({number} % {len(codes)} + 1 AS BIGINT))"


def _brand_number():
    return F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")


_BRAND_SQL = "CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER)"


def played(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item as a player (part) in an event (order)."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_partkey").alias("player_id"),
        F.col("l_orderkey").alias("event_id"),
        (F.col("l_suppkey") % 2).alias("event_team_id"),
        F.col("l_quantity").alias("proj_points"),
        F.when(F.col("l_tax") < 0.08, whole("l_extendedprice")).alias("actual_points"),
        F.col("p_type").alias("position"),
        F.col("p_name").alias("full_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("last_name"),
        _code(_brand_number(), PLAYED_CODES).alias("current_team"),
        F.concat((F.lit(2020) + F.col("l_orderkey") % 4).cast("string"), F.lit("-10-01")).alias("game_date"),
    )


PLAYED_SQL = f"""
played AS (
  SELECT l_partkey AS player_id, l_orderkey AS event_id, l_suppkey % 2 AS event_team_id,
         l_quantity AS proj_points,
         CASE WHEN l_tax < 0.08::DOUBLE THEN floor(l_extendedprice) END AS actual_points,
         p_type AS position, p_name AS full_name, split_part(p_name, ' ', 2) AS last_name,
         {_code_sql(_BRAND_SQL, PLAYED_CODES)} AS current_team,
         (2020 + l_orderkey % 4) || '-10-01' AS game_date
  FROM lineitem JOIN part ON l_partkey = p_partkey),
performances AS (
  SELECT * FROM played WHERE proj_points > 0
  QUALIFY row_number() OVER (PARTITION BY player_id, event_id, event_team_id
                             ORDER BY proj_points, actual_points NULLS LAST) = 1)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line per team and name word on each of four days."""
    days = F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.concat((i + 2020).cast("string"), F.lit("-10-01"))))
    words = table(spark, sf_dir, "part").select(
        _code(_brand_number(), TEAM_CODES).alias("team"), F.explode(F.split("p_name", " ")).alias("last_name")
    )
    return (
        words.groupBy("team", "last_name")
        .agg(F.concat(F.lit("f"), (F.count(F.lit(1)) % 4 + 1).cast("string")).alias("line"))
        .select("team", "last_name", "line", days.alias("game_date"))
    )


LINES_SQL = f"""
lines AS (
  SELECT team, last_name, 'f' || (count(*) % 4 + 1) AS line, (2020 + d) || '-10-01' AS game_date
  FROM (SELECT {_code_sql(_BRAND_SQL, TEAM_CODES)} AS team, unnest(string_split(p_name, ' ')) AS last_name
        FROM part), range(4) t(d)
  GROUP BY team, last_name, d)"""
