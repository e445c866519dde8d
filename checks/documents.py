"""Raw documents built from the driver's tables, parsed from JSON text again and normalised.

Documents are cut by primary key into chunks of fixed size, so that none of them grows with the
data. The SQL side works on the flat tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import tables as t
from checks.registry import query
from slatecraft.functions.numeric import round_to
from slatecraft.functions.text import SLATE_TYPES
from slatecraft.operators.reshape import slot_names
from slatecraft.plans import normalise, summaries
from slatecraft.plans.top_lineups import SINGLE_GAME_SLOTS
from slatecraft.sources import schemas

CHUNK = 32


def chunk(key: str, size: int = CHUNK):
    return F.expr(f"{key} div {size}")


def parsed(rows: DataFrame, document, schema, *extra) -> DataFrame:
    """Rows written as JSON text and read back with the declared schema."""
    text = F.to_json(F.struct(*document))
    return rows.select(*extra, F.from_json(text, schema).alias("d")).select(*extra, "d.*")


def text(c) -> "F.Column":
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# --- contests ---------------------------------------------------------------------------------


def raw_contests(spark, sf_dir):
    contest = F.struct(
        text("c_custkey").alias("contest_id"),
        F.col("c_name").alias("contest_name"),
        text("c_acctbal").alias("contest_size"),
        text("c_nationkey").alias("entry_cost"),
        F.lit("n/a").alias("total_prizes"),
        F.lit("150.0").alias("multi_entry_max"),
        text(F.col("c_acctbal") > 0).alias("is_largest_by_size"),
        F.lit("true").alias("is_primary"),
        F.col("c_mktsegment").alias("tour"),
        F.lit("4").alias("source_id"),
        text(F.col("c_nationkey") + 7).alias("sport_event_id"),
        text(F.col("c_nationkey") % 5).alias("contest_group_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", text("c_nationkey")).alias("cash_line"),
        F.lit("20250907").alias("date_id"),
    )
    rows = t.table(spark, sf_dir, "customer").groupBy(chunk("c_custkey").alias("k"))
    return parsed(rows.agg(F.collect_list(contest).alias("live_contests")), ["live_contests"], schemas.CONTESTS_RAW)


@query(
    "dds1_contests",
    """SELECT CAST(c_custkey AS INTEGER) AS contest_id, c_name AS contest_name, CAST(round(c_acctbal) AS INTEGER) AS contest_size,
       c_nationkey AS entry_cost, CAST(NULL AS INTEGER) AS total_prizes, 150 AS multi_entry_max,
       c_acctbal > 0 AS is_largest_by_size, true AS is_primary, c_mktsegment AS tour, 4 AS source_id,
       c_nationkey + 7 AS sport_event_id, CAST(c_nationkey % 5 AS INTEGER) AS contest_group_id,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey END AS cash_line, 20250907 AS date_id
FROM customer""",
)
def dds1(spark, sf_dir):
    return normalise.contests(raw_contests(spark, sf_dir))


# --- players ----------------------------------------------------------------------------------


def raw_players(spark, sf_dir):
    player = F.struct(
        text("p_partkey").alias("playerId"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("firstName"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("lastName"),
        F.col("p_name").alias("fullName"),
        text("p_retailprice").alias("salary"),
        F.col("p_type").alias("position"),
        F.lit("FLEX").alias("rosterPosition"),
        F.col("p_brand").alias("currentTeam"),
        text("p_size").alias("currentTeamId"),
        text(F.col("p_size") * 3).alias("eventId"),
        text(F.col("p_size") % 2).alias("eventTeamId"),
        F.when(F.col("p_size") % 2 == 0, "home").otherwise("visitor").alias("homeVisitor"),
        F.lit("fav").alias("favDog"),
        text("p_retailprice").alias("projPoints"),
        text(F.col("p_size") / 2).alias("ownership"),
        F.when(F.col("p_size") > 5, text("p_size")).alias("actualPoints"),
        F.lit("").alias("statDetails"),
        F.lit("1").alias("madeCut"),
    )
    entry = F.struct(F.concat(F.lit("k"), text("p_partkey")), player)
    rows = (
        t.table(spark, sf_dir, "part")
        .groupBy(chunk("p_partkey").alias("k"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("players"))
        .select(F.explode(F.array(F.lit(1), F.lit(2))).alias("contest"), "players")
    )
    return parsed(rows, ["players"], schemas.CONTEST_ANALYZE_RAW)


@query(
    "dds2_players",
    """SELECT 'k' || p_partkey AS player_key, CAST(p_partkey AS INTEGER) AS player_id,
       split_part(p_name, ' ', 1) AS first_name, split_part(p_name, ' ', 2) AS last_name, p_name AS full_name,
       CAST(round(p_retailprice) AS INTEGER) AS salary, p_type AS position, 'FLEX' AS roster_position,
       p_brand AS current_team, p_size AS current_team_id, p_size * 3 AS event_id,
       CAST(p_size % 2 AS INTEGER) AS event_team_id, CASE WHEN p_size % 2 = 0 THEN 'home' ELSE 'visitor' END AS home_visitor,
       'fav' AS fav_dog, p_retailprice AS proj_points, p_size / 2 AS ownership,
       CASE WHEN p_size > 5 THEN CAST(p_size AS DOUBLE) END AS actual_points, '' AS stat_details, 1 AS made_cut
FROM part""",
)
def dds2(spark, sf_dir):
    return normalise.players(raw_players(spark, sf_dir))


# --- draft groups -----------------------------------------------------------------------------

SOURCES = sorted(SLATE_TYPES)
_SOURCE_SQL = f"list_extract({SOURCES}, CAST(substr(o_orderpriority, 1, 1) AS BIGINT))"


def raw_draft_groups(spark, sf_dir):
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    source = F.element_at(F.array(*[F.lit(s) for s in SOURCES]), priority)
    group = F.struct(
        text("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("contest_start_date"),
        F.lit("0001-01-01 00:00:00").alias("contest_end_date"),
        F.col("o_orderstatus").alias("contest_suffix"),
        text(F.col("o_orderkey") + 1).alias("draft_group_id"),
        text(F.dayofmonth("o_orderdate")).alias("game_count"),
        F.lit("false").alias("is_simlabs"),
        F.struct(text(F.col("o_custkey") % 4).alias("id")).alias("sport"),
    )
    rows = (
        t.table(spark, sf_dir, "orders")
        .withColumn("source", source)
        .withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .groupBy(chunk("o_orderkey").alias("k"), "source", F.col("day").alias("date"))
        .agg(F.collect_list(group).alias("draft_groups"))
    )
    document = F.struct(
        text("source").alias("id"),
        F.concat(F.lit("source "), text("source")).alias("source_name"),
        F.lit("display").alias("display_name"),
        F.lit("short").alias("short_name"),
        F.lit("true").alias("is_primary"),
        F.lit("false").alias("is_active"),
        "draft_groups",
    )
    return parsed(rows, [document.alias("contest-sources")], schemas.DRAFT_GROUPS_RAW, "date")


@query(
    "dds3_draft_groups",
    f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date,
       CASE {_SOURCE_SQL} WHEN 4 THEN 'dk_classic' ELSE 'dk_single_game' END AS game_type,
       CAST(o_orderkey AS INTEGER) AS draft_group_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS contest_start_date,
       '0001-01-01 00:00:00' AS contest_end_date, o_orderstatus AS contest_suffix,
       CAST(o_orderkey + 1 AS INTEGER) AS draft_group_reference_id, CAST(day(o_orderdate) AS INTEGER) AS game_count,
       false AS is_simlabs, CAST(o_custkey % 4 AS INTEGER) AS sport_id, {_SOURCE_SQL} AS source_id,
       'source ' || {_SOURCE_SQL} AS source_name, 'display' AS display_name, 'short' AS short_name,
       true AS is_primary, false AS is_active, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id
FROM orders WHERE {_SOURCE_SQL} IN (4, 8)""",
)
def dds3(spark, sf_dir):
    found = normalise.draft_groups(raw_draft_groups(spark, sf_dir))
    stamps = ("contest_start_date", "contest_end_date")
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})


# --- users and their line-ups -----------------------------------------------------------------

ENTRIES = 8


def raw_users(spark, sf_dir, copies: int = 1):
    lineup = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("h"), text("o_orderkey"))).alias("lineupHash"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("lineupCt"),
    )
    per_user = (
        t.table(spark, sf_dir, "orders")
        .groupBy(chunk("o_orderkey", ENTRIES).alias("k"), "o_custkey")
        .agg(
            F.count(F.lit(1)).cast("int").alias("n"),
            F.sum(t.whole("o_totalprice")).alias("cost"),
            F.map_from_entries(F.collect_list(F.struct(text("o_orderkey"), lineup))).alias("lineups"),
        )
    )
    counts = (
        "totalPlayers totalRosters uniqueRosters lineupsCashing lineupsInPercentile1 lineupsInPercentile2 "
        "lineupsInPercentile5 lineupsInPercentile10 lineupsInPercentile20 lineupsInPercentile50"
    ).split()
    user = F.struct(
        F.concat(F.lit("u"), text("o_custkey")).alias("userId"),
        *[(F.col("n") + i).alias(c) for i, c in enumerate(counts)],
        F.lit(0.5).alias("maxExposure"),
        F.col("cost").alias("totalEntryCost"),
        (F.col("cost") * 2).alias("totalWinning"),
        F.col("cost").alias("roi"),
        "lineups",
    )
    rows = (
        per_user.groupBy("k")
        .agg(F.map_from_entries(F.collect_list(F.struct(text("o_custkey"), user))).alias("users"))
        .select("k", "users", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    )
    contest = F.struct(text("k").alias("contestId")).alias("contest")
    return parsed(rows, [contest, "users"], schemas.CONTEST_ANALYZE_RAW)


_COUNTS = (
    "total_players total_rosters unique_rosters lineups_cashing lineups_in_percentile_1 lineups_in_percentile_2 "
    "lineups_in_percentile_5 lineups_in_percentile_10 lineups_in_percentile_20 lineups_in_percentile_50"
).split()


@query(
    "dds4_users",
    f"""SELECT o_orderkey // {ENTRIES} AS contest_id, 'u' || o_custkey AS user_id,
       {', '.join(f'CAST(count(*) + {i} AS INTEGER) AS {c}' for i, c in enumerate(_COUNTS))},
       0.5::DOUBLE AS max_exposure, sum(floor(o_totalprice)) AS total_entry_cost,
       2 * sum(floor(o_totalprice)) AS total_winning, sum(floor(o_totalprice)) AS roi
FROM orders GROUP BY 1, o_custkey""",
)
def dds4(spark, sf_dir):
    return normalise.users(raw_users(spark, sf_dir, copies=2))


@query(
    "dds5_user_lineups",
    f"""SELECT o_orderkey // {ENTRIES} AS contest_id, 'u' || o_custkey AS user_id, 'h' || o_orderkey AS lineup_hash,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS lineup_ct FROM orders WHERE o_orderstatus <> 'P'""",
)
def dds5(spark, sf_dir):
    return normalise.user_lineups(raw_users(spark, sf_dir))


# --- line-ups ---------------------------------------------------------------------------------


def raw_lineups(spark, sf_dir):
    """Every line-up twice, as the same contest landed twice; empty slots are missing keys."""
    cells = [F.struct(F.lit(s.upper()), F.col(f"pos_{s}").cast("int")) for s in SINGLE_GAME_SLOTS]
    slots = F.map_filter(F.map_from_entries(F.array(*cells)), lambda k, v: v.isNotNull())
    stacks = F.when(
        F.col("correlated_players") > 1,
        F.array(F.struct(F.lit("T").alias("team"), F.col("correlated_players").cast("int").alias("playerCount"))),
    ).otherwise(F.array())
    lineup = F.struct(
        F.col("lineup_hash").alias("lineupHash"),
        F.col("lineup_ct").alias("lineupCt"),
        F.lit(1).alias("lineupUserCt"),
        F.col("points"),
        F.col("total_salary").cast("int").alias("totalSalary"),
        F.col("total_own").alias("totalOwn"),
        F.col("min_own").alias("minOwn"),
        F.col("max_own").alias("maxOwn"),
        F.col("avg_own").alias("avgOwn"),
        F.col("lineup_rank").alias("lineupRank"),
        F.col("is_cashing").alias("isCashing"),
        F.col("payout"),
        F.col("lineup_percentile").alias("lineupPercentile"),
        F.col("correlated_players").cast("int").alias("correlatedPlayers"),
        slots.alias("lineupPlayers"),
        stacks.alias("teamStacks"),
        F.create_map(F.lit("hot"), F.col("is_cashing")).alias("lineupTrends"),
        F.array("user_id").alias("entryNameList"),
    )
    rows = t.lineups(spark, sf_dir, SINGLE_GAME_SLOTS).select(
        F.col("contest_id").alias("slate_id"), lineup.alias("lineups")
    )
    twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return parsed(twice, ["slate_id", "lineups"], schemas.LINEUPS_RAW)


@query(
    "dds6_lineups",
    f"""WITH {t.lineups_sql(SINGLE_GAME_SLOTS)}
SELECT contest_id, lineup_hash, lineup_ct, 1 AS lineup_user_ct, points, CAST(total_salary AS INTEGER) AS total_salary,
       total_own, min_own, max_own, {'round((avg_own) * 1000000) / 1000000'} AS avg_own, lineup_rank, is_cashing,
       CAST(NULL AS INTEGER) AS favorite_ct, CAST(NULL AS INTEGER) AS underdog_ct, CAST(NULL AS INTEGER) AS home_ct,
       CAST(NULL AS INTEGER) AS visitor_ct, payout, round((lineup_percentile) * 1000000) / 1000000 AS lineup_percentile,
       CAST(correlated_players AS INTEGER) AS correlated_players,
       {', '.join(f'CAST(pos_{s} AS INTEGER) AS pos_{s}' for s in SINGLE_GAME_SLOTS)},
       CASE WHEN correlated_players > 1 THEN '[{{"team":"T","playerCount":' || correlated_players || '}}]' END AS team_stacks,
       CAST(NULL AS VARCHAR) AS game_stacks, '{{"hot":' || is_cashing || '}}' AS lineup_trends,
       '["' || user_id || '"]' AS entry_name_list
FROM lineups""",
)
def dds6(spark, sf_dir):
    found = normalise.lineups(raw_lineups(spark, sf_dir), SINGLE_GAME_SLOTS)
    return found.withColumns({c: round_to(F.col(c), 6) for c in ("avg_own", "lineup_percentile")})


@query(
    "rsh12_slot_names",
    f"""WITH {t.lineups_sql(SINGLE_GAME_SLOTS)}
SELECT slot, count(*) AS lineups FROM (
  UNPIVOT (SELECT {', '.join(f'pos_{s} AS {s}' for s in SINGLE_GAME_SLOTS)} FROM lineups)
  ON {', '.join(SINGLE_GAME_SLOTS)} INTO NAME slot VALUE player) GROUP BY slot""",
)
def rsh12(spark, sf_dir):
    """Slots that occur in the maps of the raw line-ups, as columns, and how many line-ups fill them."""
    placed = normalise.placed_lineups(raw_lineups(spark, sf_dir))
    slots = slot_names(placed, "_players")
    filled = normalise.last_landed(placed, slots).agg(*[F.count(f"pos_{s}").alias(s) for s in slots])
    return filled.unpivot([], slots, "slot", "lineups").filter(F.col("lineups") > 0)


# --- lines ------------------------------------------------------------------------------------


def line_stats(spark, sf_dir):
    kind = F.when(F.col("p_type").isin("ECONOMY", "LARGE"), "line").when(
        F.col("p_type").isin("MEDIUM", "PROMO"), "pairing"
    )
    kind = kind.when(F.col("p_type") == "SMALL", "G").otherwise("other")
    return t.table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "SMALL", F.col("p_name"))
        .otherwise(F.replace("p_name", F.lit(" "), F.lit(" -")))
        .alias("playerName"),
        F.col("p_brand").alias("team"),
        (F.col("p_size") % 7 - 1).cast("double").alias("iceTimeRank"),
        kind.alias("position"),
        F.when(F.col("p_size") <= 40, "5on5").otherwise("all").alias("situation"),
        F.concat(F.lit("2024-10-"), F.lpad(text(F.col("p_partkey") % 28 + 1), 2, "0")).alias("game_date"),
    )


@query(
    "dds7_lines",
    """WITH stats AS (
  SELECT p_name, p_brand AS team, p_size % 7 - 1 AS rank, p_type,
         '2024-10-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') AS game_date
  FROM part WHERE p_size <= 40)
SELECT game_date, unnest(string_split(p_name, ' ')) AS last_name, team, 'f' || rank AS line
FROM stats WHERE p_type IN ('ECONOMY', 'LARGE') AND rank <= 4
UNION ALL
SELECT game_date, unnest(string_split(p_name, ' ')), team, 'd' || rank FROM stats
WHERE p_type IN ('MEDIUM', 'PROMO') AND rank <= 3
UNION ALL
SELECT game_date, p_name, team, 'G1' FROM stats WHERE p_type = 'SMALL' AND rank = -1""",
)
def dds7(spark, sf_dir):
    return normalise.lines(line_stats(spark, sf_dir))


# --- staging ----------------------------------------------------------------------------------


@query(
    "dds8_tagged_lineups",
    f"SELECT o_orderkey // {CHUNK} AS slate_id, 'h' || o_orderkey AS lineup_hash, floor(o_totalprice) AS points FROM orders",
)
def dds8(spark, sf_dir):
    lineup = F.struct(F.concat(F.lit("h"), text("o_orderkey")).alias("lineupHash"), t.whole("o_totalprice").alias("points"))
    payloads = (
        t.table(spark, sf_dir, "orders")
        .groupBy(chunk("o_orderkey").alias("contest"))
        .agg(F.collect_list(lineup).alias("lineups"))
    )
    return normalise.tagged_lineups(payloads, "contest").select(
        "slate_id", F.col("lineups.lineupHash").alias("lineup_hash"), "lineups.points"
    )


@query(
    "dds9_load_time",
    "SELECT count(*) AS row_count, count(*) AS with_load_time, 1 AS loads FROM events",
)
def dds9(spark, sf_dir):
    stamped = normalise.with_load_time(t.table(spark, sf_dir, "events"))
    return stamped.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("load_ts").alias("with_load_time"),
        F.count_distinct("load_ts").cast("int").alias("loads"),
    )


# --- betting lines ----------------------------------------------------------------------------


def raw_odds(spark, sf_dir):
    """A game per user and event type; opening and closing lines are its first and last event."""
    order = F.struct("ts", "event_id")
    games = (
        t.table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type")
        .agg(
            F.min_by("value", order).alias("opened"),
            F.max_by("value", order).alias("closed"),
            F.date_format(F.min("ts"), "yyyy-MM-dd").alias("date"),
        )
        .withColumn("game_id", F.concat_ws("-", "user_id", "event_type"))
    )

    def american(value):
        sign = F.when(value >= 0, "+").otherwise("")
        return F.struct(F.concat(sign, text(value)).alias("american"))

    def point(value):
        return F.struct(american(value).alias("pointSpread"), american(F.floor(value)).alias("moneyLine"))

    def competitor(side):
        return F.struct(
            F.lit(side).alias("homeAway"),
            F.struct(F.concat(F.lit(f"{side} "), text("user_id")).alias("displayName")).alias("team"),
        )

    home = F.struct(point(F.col("opened")).alias("open"), point(F.col("closed")).alias("close"))
    away = F.struct(point(-F.floor("opened")).alias("open"), point(-F.floor("closed")).alias("close"))

    def item(provider):
        return F.struct(
            F.struct(F.lit(provider).alias("id")).alias("provider"),
            home.alias("homeTeamOdds"),
            away.alias("awayTeamOdds"),
            F.struct(american(F.lit(44.5)).alias("total")).alias("open"),
        )

    event = F.struct(
        F.col("game_id").alias("id"),
        F.concat(F.lit("game "), F.col("game_id")).alias("name"),
        F.col("date"),
        F.array(F.struct(F.array(competitor("home"), competitor("away")).alias("competitors"))).alias("competitions"),
    )
    listed = F.when(F.col("event_type") != "view", F.array(event)).otherwise(F.array())
    response = F.struct(
        "game_id",
        F.when(F.col("event_type") != "error", F.struct(F.array(item("59"), item("58")).alias("items"))).alias(
            "odds_data"
        ),
    )
    document = [
        F.lit("v1").alias("version"),
        F.col("date"),
        F.lit("NBA").alias("sport"),
        F.concat("date", F.lit("T00:00:00")).alias("fetch_timestamp"),
        F.struct(listed.alias("events")).alias("scoreboard_response"),
        F.array(response).alias("odds_responses"),
    ]
    return parsed(games, document, schemas.ODDS_RAW)


_GAMES_SQL = """games AS (
  SELECT user_id, event_type, user_id || '-' || event_type AS game_id, strftime(min(ts), '%Y-%m-%d') AS date,
         arg_min(value, (ts, event_id)) AS opened, arg_max(value, (ts, event_id)) AS closed
  FROM events GROUP BY user_id, event_type)"""


@query(
    "dds10_games",
    f"""WITH {_GAMES_SQL} SELECT game_id, date, 'NBA' AS sport, 'home ' || user_id AS home_team,
       'away ' || user_id AS away_team, date AS game_time FROM games WHERE event_type <> 'view'""",
)
def dds10_games(spark, sf_dir):
    return normalise.odds_games(raw_odds(spark, sf_dir))


@query(
    "dds10_pregame_odds",
    f"""WITH {_GAMES_SQL} SELECT game_id, '58' AS provider_id, date || 'T00:00:00' AS fetch_time,
       opened AS spread_open, closed AS spread_close, floor(opened) AS moneyline_home_open,
       floor(closed) AS moneyline_home_close, CASE WHEN floor(opened) = 0 THEN 0 ELSE -floor(opened) END AS moneyline_away_open,
       CASE WHEN floor(closed) = 0 THEN 0 ELSE -floor(closed) END AS moneyline_away_close,
       44.5::DOUBLE AS total_open, CAST(NULL AS DOUBLE) AS total_close
FROM games WHERE event_type <> 'error'""",
)
def dds10_pregame(spark, sf_dir):
    return normalise.pregame_odds(raw_odds(spark, sf_dir))


@query(
    "dds10_line_movement",
    f"""WITH {_GAMES_SQL}, kinds AS (
  SELECT game_id, 'spread' AS movement_type, opened AS open_value, closed AS close_value FROM games WHERE event_type <> 'error'
  UNION ALL SELECT game_id, 'total', 44.5::DOUBLE, NULL FROM games WHERE event_type <> 'error'
  UNION ALL SELECT game_id, 'moneyline_home', floor(opened), floor(closed) FROM games WHERE event_type <> 'error'
  UNION ALL SELECT game_id, 'moneyline_away', 0 - floor(opened), 0 - floor(closed) FROM games WHERE event_type <> 'error')
SELECT *, close_value - open_value AS movement_amount, open_value <> close_value AS moved FROM kinds""",
)
def dds10_movement(spark, sf_dir):
    return normalise.line_movements(normalise.pregame_odds(raw_odds(spark, sf_dir)))


@query(
    "jn19_game_names",
    f"""WITH {_GAMES_SQL} SELECT game_id, CASE event_type WHEN 'view' THEN 'Unknown' ELSE 'game ' || game_id END AS game_name
FROM games""",
)
def jn19(spark, sf_dir):
    return normalise.game_names(raw_odds(spark, sf_dir))


@query(
    "agg26_odds_load_summary",
    f"""WITH {_GAMES_SQL} SELECT date, sum(CASE event_type WHEN 'view' THEN 0 ELSE 1 END)::BIGINT AS games,
       sum(CASE event_type WHEN 'error' THEN 0 ELSE 1 END)::BIGINT AS games_with_odds FROM games GROUP BY date""",
)
def agg26(spark, sf_dir):
    summary = normalise.odds_load_summary(raw_odds(spark, sf_dir))
    return summary.groupBy("date").agg(
        F.sum("games").alias("games"), F.sum("games_with_odds").alias("games_with_odds")
    )


@query(
    "flt16_scheduled_games",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey AS game_id FROM orders WHERE o_orderstatus <> 'P'""",
)
def flt16(spark, sf_dir):
    """A schedule document per order that lists its day, or only the next day for status P."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    after = F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd")
    games = F.array(F.struct(F.col("o_orderkey").alias("id")))
    entry = F.struct(F.when(F.col("o_orderstatus") == "P", after).otherwise(day).alias("date"), games.alias("games"))
    other = F.struct(F.lit("1900-01-01").alias("date"), games.alias("games"))
    rows = t.table(spark, sf_dir, "orders").select(day.alias("date"), F.array(other, entry).alias("gameWeek"))
    schedules = parsed(rows, ["gameWeek"], schemas.SCHEDULE, "date")
    return normalise.scheduled_games(schedules).select("date", F.col("game.id").alias("game_id"))


@query(
    "flt10_scrape_day",
    """SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey)
  ON l_orderkey = o_orderkey WHERE date_trunc('year', o_orderdate) = date_trunc('year', d)""",
)
def flt10(spark, sf_dir):
    shipped = t.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("d"))
    orders = t.table(spark, sf_dir, "orders")
    both = orders.join(shipped, orders["o_orderkey"] == shipped["l_orderkey"]).select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("contest_start_date"),
        F.date_format("d", "yyyy").alias("date"),
    )
    return normalise.on_scrape_day(both).select("o_orderkey")


# --- nested orders ----------------------------------------------------------------------------


def nested_orders(spark, sf_dir):
    orders, customers = t.table(spark, sf_dir, "orders"), t.table(spark, sf_dir, "customer")
    customer = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("email"),
    )
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("o_orderkey").alias("order_id"),
        customer.alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        t.whole("o_totalprice").alias("total"),
    )


@query(
    "dds11_flat_orders",
    """SELECT o_orderkey AS order_id, c_custkey AS customer_id, c_name AS customer_name,
       lower(c_mktsegment) || '@example.com' AS customer_email, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       floor(o_totalprice) AS order_total FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def dds11_flat(spark, sf_dir):
    return summaries.flat_orders(nested_orders(spark, sf_dir)).withColumn("order_date", text("order_date"))


@query(
    "dds11_customer_summary",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_mktsegment) || '@example.com' AS customer_email,
       count(*) AS total_orders, sum(floor(o_totalprice)) AS total_revenue, avg(floor(o_totalprice)) AS avg_order_value,
       strftime(min(o_orderdate), '%Y-%m-%d') AS first_order_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_order_date
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def dds11(spark, sf_dir):
    found = summaries.customer_summary(summaries.flat_orders(nested_orders(spark, sf_dir)))
    return found.withColumns({c: text(c) for c in ("first_order_date", "last_order_date")})
