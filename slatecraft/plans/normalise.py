"""Raw documents to typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.functions.casting import (
    bool_from_text,
    double_from_text,
    int_from_double,
    int_from_text,
    timestamp_from_text,
)
from slatecraft.functions.metrics import american_number, line_moved, movement
from slatecraft.functions.text import NORMALISED_SLATE_TYPES, SLATE_TYPES, lookup, name_parts
from slatecraft.operators.reshape import explode_map, with_slots

# --- fixed values: raw field names, output names and the on-ice situation of line statistics -----
PLAYER_FIELDS = {
    "player_id": ("playerId", int_from_text),
    "first_name": ("firstName", None),
    "last_name": ("lastName", None),
    "full_name": ("fullName", None),
    "salary": ("salary", int_from_text),
    "position": ("position", None),
    "roster_position": ("rosterPosition", None),
    "current_team": ("currentTeam", None),
    "current_team_id": ("currentTeamId", int_from_text),
    "event_id": ("eventId", int_from_text),
    "event_team_id": ("eventTeamId", int_from_text),
    "home_visitor": ("homeVisitor", None),
    "fav_dog": ("favDog", None),
    "proj_points": ("projPoints", double_from_text),
    "ownership": ("ownership", double_from_text),
    "actual_points": ("actualPoints", double_from_text),
    "stat_details": ("statDetails", None),
    "made_cut": ("madeCut", int_from_text),
}
CONTEST_FIELDS = {
    "contest_id": int_from_text,
    "contest_name": None,
    "contest_size": int_from_text,
    "entry_cost": int_from_text,
    "total_prizes": int_from_text,
    "multi_entry_max": int_from_text,
    "is_largest_by_size": bool_from_text,
    "is_primary": bool_from_text,
    "tour": None,
    "source_id": int_from_text,
    "sport_event_id": int_from_text,
    "contest_group_id": int_from_text,
    "cash_line": int_from_text,
    "date_id": int_from_text,
}
USER_FIELDS = {
    "user_id": "userId",
    "total_players": "totalPlayers",
    "total_rosters": "totalRosters",
    "unique_rosters": "uniqueRosters",
    "max_exposure": "maxExposure",
    "lineups_cashing": "lineupsCashing",
    "lineups_in_percentile_1": "lineupsInPercentile1",
    "lineups_in_percentile_2": "lineupsInPercentile2",
    "lineups_in_percentile_5": "lineupsInPercentile5",
    "lineups_in_percentile_10": "lineupsInPercentile10",
    "lineups_in_percentile_20": "lineupsInPercentile20",
    "lineups_in_percentile_50": "lineupsInPercentile50",
    "total_entry_cost": "totalEntryCost",
    "total_winning": "totalWinning",
    "roi": "roi",
}
LINEUP_FIELDS = {
    "lineup_hash": "lineupHash",
    "lineup_ct": "lineupCt",
    "lineup_user_ct": "lineupUserCt",
    "points": "points",
    "total_salary": "totalSalary",
    "total_own": "totalOwn",
    "min_own": "minOwn",
    "max_own": "maxOwn",
    "avg_own": "avgOwn",
    "lineup_rank": "lineupRank",
    "is_cashing": "isCashing",
    "favorite_ct": "favoriteCt",
    "underdog_ct": "underdogCt",
    "home_ct": "homeCt",
    "visitor_ct": "visitorCt",
    "payout": "payout",
    "lineup_percentile": "lineupPercentile",
    "correlated_players": "correlatedPlayers",
}
LINEUP_JSON = {
    "team_stacks": "teamStacks",
    "game_stacks": "gameStacks",
    "lineup_trends": "lineupTrends",
    "entry_name_list": "entryNameList",
}
EVEN_STRENGTH = "5on5"
PREGAME_PROVIDER = "58"
# ----------------------------------------------------------------------------------------------


def _cast(column: Column, how) -> Column:
    return how(column) if how else column


def _partition(raw: DataFrame, names: Sequence[str]) -> list[str]:
    """Partition columns that came along with the raw rows."""
    return [n for n in names if n in raw.columns]


PARTITION = ("sport", "game_type", "date")


def contests(raw: DataFrame) -> DataFrame:
    """One row per live contest."""
    keep = _partition(raw, PARTITION)
    return raw.select(*keep, F.explode("live_contests").alias("c")).select(
        *keep, *[_cast(F.col(f"c.{name}"), how).alias(name) for name, how in CONTEST_FIELDS.items()]
    )


def players(raw: DataFrame) -> DataFrame:
    """One row per distinct player entry of all contests of a day."""
    keep = _partition(raw, PARTITION)
    return (
        explode_map(raw, keep, F.col("players"), "player_key", "p")
        .select(
            *keep,
            "player_key",
            *[_cast(F.col(f"p.{field}"), how).alias(name) for name, (field, how) in PLAYER_FIELDS.items()],
        )
        .distinct()
    )


def draft_groups(raw: DataFrame, slate_types: Sequence[str] = NORMALISED_SLATE_TYPES) -> DataFrame:
    """Draft groups of the sources with a normalised slate type, all types in one pass.

    ``game_type`` comes from the source id and ``date_id`` from the day of the file, column ``date``.
    """
    keep = [c for c in _partition(raw, PARTITION) if c != "game_type"]
    source = F.col("contest-sources")
    sources = raw.select(*keep, source.alias("s")).withColumn("source_id", int_from_text(F.col("s.id")))
    known = sources.withColumn("game_type", lookup(F.col("source_id"), SLATE_TYPES)).filter(
        F.col("game_type").isin(*slate_types)
    )
    groups = known.select(*keep, "game_type", "source_id", "s", F.explode("s.draft_groups").alias("g"))
    return groups.select(
        *keep,
        "game_type",
        int_from_text(F.col("g.id")).alias("draft_group_id"),
        timestamp_from_text(F.col("g.contest_start_date")).alias("contest_start_date"),
        timestamp_from_text(F.col("g.contest_end_date")).alias("contest_end_date"),
        F.col("g.contest_suffix").alias("contest_suffix"),
        int_from_text(F.col("g.draft_group_id")).alias("draft_group_reference_id"),
        int_from_text(F.col("g.game_count")).alias("game_count"),
        bool_from_text(F.col("g.is_simlabs")).alias("is_simlabs"),
        int_from_text(F.col("g.sport.id")).alias("sport_id"),
        "source_id",
        F.col("s.source_name").alias("source_name"),
        F.col("s.display_name").alias("display_name"),
        F.col("s.short_name").alias("short_name"),
        bool_from_text(F.col("s.is_primary")).alias("is_primary"),
        bool_from_text(F.col("s.is_active")).alias("is_active"),
        int_from_text(F.replace(F.col("date").cast("string"), F.lit("-"), F.lit(""))).alias("date_id"),
    ).distinct()


def _user_entries(raw: DataFrame) -> DataFrame:
    keep = _partition(raw, PARTITION)
    return raw.select(
        *keep,
        int_from_text(F.col("contest.contestId"), "bigint").alias("contest_id"),
        F.explode(F.map_values("users")).alias("u"),
    )


def users(raw: DataFrame) -> DataFrame:
    """One row per distinct user entry of a contest."""
    keep = _partition(raw, PARTITION)
    return (
        _user_entries(raw)
        .select(*keep, "contest_id", *[F.col(f"u.{f}").alias(name) for name, f in USER_FIELDS.items()])
        .distinct()
    )


def user_lineups(raw: DataFrame) -> DataFrame:
    """One row per user and line-up; entries without a hash are dropped, repeats are kept."""
    keep = _partition(raw, PARTITION)
    return (
        _user_entries(raw)
        .select(
            *keep,
            "contest_id",
            F.col("u.userId").alias("user_id"),
            F.explode(F.map_values("u.lineups")).alias("l"),
        )
        .select(
            *keep,
            "contest_id",
            "user_id",
            F.col("l.lineupHash").alias("lineup_hash"),
            F.col("l.lineupCt").alias("lineup_ct"),
        )
        .dropna(subset=["lineup_hash"])
    )


def json_or_null(nested: Column) -> Column:
    """JSON text of a list or map; null when it is empty or missing."""
    return F.when(F.size(nested) > 0, F.to_json(nested))


def lineups(raw: DataFrame, slots: Sequence[str]) -> DataFrame:
    """One row per line-up, with a column per slot and nested details as JSON text.

    ``slots`` is the list of the game type; a line-up without a slot has null there. A line-up that
    was landed twice for a contest counts once, as it was landed last; ties go to the largest 64-bit hash of
    the row. Line-ups without a hash can't be told apart and all count.
    """
    return last_landed(placed_lineups(raw), slots)


def placed_lineups(raw: DataFrame) -> DataFrame:
    """Line-ups with their details as text, slots still as a map ``_players``, and the load time ``_loaded``."""
    keep = _partition(raw, PARTITION)
    loaded = F.col("load_ts") if "load_ts" in raw.columns else F.lit(None).cast("timestamp")
    return raw.select(
        *keep,
        F.col("slate_id").alias("contest_id"),
        *[F.col(f"lineups.{f}").alias(name) for name, f in LINEUP_FIELDS.items()],
        F.col("lineups.lineupPlayers").alias("_players"),
        *[json_or_null(F.col(f"lineups.{f}")).alias(name) for name, f in LINEUP_JSON.items()],
        loaded.alias("_loaded"),
    )


def last_landed(placed: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Slots as columns, and of each contest and line-up the row landed last."""
    before = [c for c in placed.columns if c not in ("_players", "_loaded", *LINEUP_JSON)]
    rows = with_slots(placed, "_players", slots)
    columns = [*before, *[f"pos_{s}" for s in slots], *[c for c in LINEUP_JSON]]
    # a row without a hash is alone in its group
    alone = F.when(F.col("lineup_hash").isNull(), F.monotonically_increasing_id())
    hashed = rows.withColumns({"_alone": alone, "_hash": F.xxhash64(*columns)})
    keys = [*_partition(placed, PARTITION), "contest_id", "lineup_hash", "_alone"]
    newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("_loaded"), F.desc("_hash"))
    return hashed.withColumn("_place", F.row_number().over(newest)).where("_place = 1").select(*columns)


def line_label(position: Column, rank: Column) -> Column:
    """Forward line ``f1``-``f4``, defence pair ``d1``-``d3``, first goalie ``G1``, else null."""
    number = rank.cast("string")
    return (
        F.when((position == "line") & (rank <= 4), F.concat(F.lit("f"), number))
        .when((position == "pairing") & (rank <= 3), F.concat(F.lit("d"), number))
        .when((position == "G") & (rank == -1), F.lit("G1"))
    )


def lines(stats: DataFrame, day: str = "game_date") -> DataFrame:
    """Players of each line; names of a line come joined by ``-`` and goalies alone. One pass."""
    rank = int_from_double(F.col("iceTimeRank").cast("double"))
    labelled = (
        stats.filter(F.col("situation") == EVEN_STRENGTH)
        .withColumn("line", line_label(F.col("position"), rank))
        .filter(F.col("line").isNotNull())
    )
    names = F.when(F.col("position") == "G", F.array("playerName")).otherwise(name_parts(F.col("playerName")))
    return labelled.select(
        F.col(day).alias("game_date"), F.explode(names).alias("name"), "team", "line"
    ).select("game_date", F.trim("name").alias("last_name"), "team", "line")


def tagged_lineups(payloads: DataFrame, contest: str, rows: str = "lineups") -> DataFrame:
    """Raw line-up rows out of per-contest payloads, each tagged with its contest."""
    return payloads.select(F.col(contest).alias("slate_id"), F.explode(rows).alias("lineups"))


def with_load_time(raw: DataFrame) -> DataFrame:
    return raw.withColumn("load_ts", F.current_timestamp())


def on_scrape_day(raw: DataFrame, start: str = "contest_start_date", day: str = "date") -> DataFrame:
    """Rows whose start falls on the day of their file."""
    return raw.filter(F.startswith(F.col(start), F.col(day)))


def scheduled_games(schedules: DataFrame, day: str = "date") -> DataFrame:
    """Games of the listed week that are on the day of the file."""
    matching = F.filter("gameWeek", lambda d: d["date"] == F.col(day))
    return schedules.select(day, F.explode(F.flatten(F.transform(matching, lambda d: d["games"]))).alias("game"))


# --- betting lines ----------------------------------------------------------------------------


def odds_games(raw: DataFrame) -> DataFrame:
    """One row per scheduled game with both teams."""

    def team(side: str) -> Column:
        competitors = F.col("e.competitions")[0]["competitors"]
        return F.get(F.filter(competitors, lambda c: c["homeAway"] == side), F.lit(0))["team"]["displayName"]

    return (
        raw.select("date", "sport", F.explode("scoreboard_response.events").alias("e"))
        .select(
            F.col("e.id").alias("game_id"),
            "date",
            "sport",
            team("home").alias("home_team"),
            team("away").alias("away_team"),
            F.col("e.date").alias("game_time"),
        )
        .distinct()
    )


def _odds_items(raw: DataFrame) -> DataFrame:
    responses = raw.select("date", "sport", "fetch_timestamp", F.explode("odds_responses").alias("r"))
    priced = responses.filter(F.col("r.odds_data").isNotNull())
    return priced.select(
        "date",
        "sport",
        "fetch_timestamp",
        F.col("r.game_id").alias("game_id"),
        F.explode("r.odds_data.items").alias("i"),
    )


def game_names(raw: DataFrame) -> DataFrame:
    """Games with a response, by the name on the scoreboard or ``Unknown``."""
    listed = raw.select(F.explode("scoreboard_response.events").alias("e")).select(
        F.col("e.id").alias("game_id"), F.col("e.name").alias("name")
    )
    priced = raw.select(F.explode("odds_responses").alias("r")).select(F.col("r.game_id").alias("game_id"))
    named = priced.join(listed.distinct(), "game_id", "left")
    return named.select("game_id", F.coalesce("name", F.lit("Unknown")).alias("game_name"))


def pregame_odds(raw: DataFrame, provider: str = PREGAME_PROVIDER) -> DataFrame:
    """Opening and closing lines of the pre-game provider; spreads from the home side."""
    items = _odds_items(raw).filter(F.col("i.provider.id") == provider)

    def home(moment: str, field: str) -> Column:
        return american_number(F.col(f"i.homeTeamOdds.{moment}.{field}.american"))

    def away(moment: str) -> Column:
        return american_number(F.col(f"i.awayTeamOdds.{moment}.moneyLine.american"))

    def total(moment: str) -> Column:
        return american_number(F.col(f"i.{moment}.total.american"))

    return items.select(
        "game_id",
        F.col("i.provider.id").alias("provider_id"),
        F.col("fetch_timestamp").alias("fetch_time"),
        home("open", "pointSpread").alias("spread_open"),
        home("close", "pointSpread").alias("spread_close"),
        home("open", "moneyLine").alias("moneyline_home_open"),
        home("close", "moneyLine").alias("moneyline_home_close"),
        away("open").alias("moneyline_away_open"),
        away("close").alias("moneyline_away_close"),
        total("open").alias("total_open"),
        total("close").alias("total_close"),
    )


def line_movements(pregame: DataFrame) -> DataFrame:
    """One row per game and kind of line with its opening and closing value and the difference."""
    kinds = {"spread": "spread", "total": "total", "moneyline_home": "moneyline_home", "moneyline_away": "moneyline_away"}
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("movement_type"),
                F.col(f"{c}_open").alias("open_value"),
                F.col(f"{c}_close").alias("close_value"),
            )
            for kind, c in kinds.items()
        ]
    )
    return (
        pregame.select("game_id", F.inline(rows))
        .withColumn("movement_amount", movement(F.col("open_value"), F.col("close_value")))
        .withColumn("moved", line_moved(F.col("open_value"), F.col("close_value")))
    )


def odds_load_summary(raw: DataFrame) -> DataFrame:
    """Games and games with odds per document."""
    with_odds = F.filter("odds_responses", lambda r: r["odds_data"].isNotNull())
    return raw.select(
        "date",
        "sport",
        F.size("scoreboard_response.events").alias("games"),
        F.size(with_odds).alias("games_with_odds"),
    )
