"""Declared schemas of raw documents.

Ids and hashes are keys of JSON objects in these documents, so such objects are maps: inferring
them would make a column per player or user. Fields that are cast on normalising are read as text.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(spec: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in spec.split()]


def _text(spec: str) -> list[T.StructField]:
    return _fields(spec, T.StringType())


def _struct(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


_LOAD = T.StructField("load_ts", T.StringType())
_INT, _LONG, _DOUBLE, _BOOL, _STR = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()
)

# --- fixed values: field names of the raw documents -------------------------------------------
CONTEST = _struct(
    *_text(
        "contest_id contest_name contest_size entry_cost total_prizes multi_entry_max is_largest_by_size "
        "is_primary tour source_id sport_event_id contest_group_id cash_line date_id"
    )
)
PLAYER = _struct(
    *_text(
        "playerId firstName lastName fullName salary position rosterPosition currentTeam currentTeamId "
        "eventId eventTeamId homeVisitor favDog projPoints ownership actualPoints statDetails madeCut"
    )
)
DRAFT_GROUP = _struct(
    *_text("id contest_start_date contest_end_date contest_suffix draft_group_id game_count is_simlabs"),
    T.StructField("sport", _struct(*_text("id"))),
)
CONTEST_SOURCE = _struct(
    *_text("id source_name display_name short_name is_primary is_active"),
    T.StructField("draft_groups", T.ArrayType(DRAFT_GROUP)),
)
USER_LINEUP = _struct(T.StructField("lineupHash", _STR), T.StructField("lineupCt", _INT))
USER = _struct(
    T.StructField("userId", _STR),
    *_fields(
        "totalPlayers totalRosters uniqueRosters lineupsCashing lineupsInPercentile1 lineupsInPercentile2 "
        "lineupsInPercentile5 lineupsInPercentile10 lineupsInPercentile20 lineupsInPercentile50",
        _INT,
    ),
    *_fields("maxExposure totalEntryCost totalWinning roi", _DOUBLE),
    T.StructField("lineups", T.MapType(_STR, USER_LINEUP)),
)
LINEUP = _struct(
    T.StructField("lineupHash", _STR),
    *_fields(
        "lineupCt lineupUserCt totalSalary lineupRank favoriteCt underdogCt homeCt visitorCt correlatedPlayers",
        _INT,
    ),
    *_fields("points totalOwn minOwn maxOwn avgOwn payout lineupPercentile", _DOUBLE),
    T.StructField("isCashing", _BOOL),
    T.StructField("lineupPlayers", T.MapType(_STR, _INT)),
    T.StructField(
        "teamStacks", T.ArrayType(_struct(T.StructField("team", _STR), T.StructField("playerCount", _INT)))
    ),
    T.StructField(
        "gameStacks", T.ArrayType(_struct(T.StructField("eventId", _STR), T.StructField("playerCount", _INT)))
    ),
    T.StructField("lineupTrends", T.MapType(_STR, _BOOL)),
    T.StructField("entryNameList", T.ArrayType(_STR)),
)
EVENT = _struct(
    *_text(
        "event_id home_team home_team_id away_team away_team_id start_time spread over_under weather slate_id"
    )
)

_PRICE = _struct(T.StructField("american", _STR), T.StructField("decimal", _DOUBLE))
_POINT = _struct(
    T.StructField("pointSpread", _struct(T.StructField("american", _STR))),
    T.StructField("spread", _PRICE),
    T.StructField("moneyLine", _PRICE),
)
_TEAM_ODDS = _struct(
    T.StructField("moneyLine", _INT),
    *_fields("open close current", _POINT),
)
_TOTAL = _struct(T.StructField("total", _struct(T.StructField("american", _STR))))
_ODDS_ITEM = _struct(
    T.StructField("provider", _struct(T.StructField("id", _STR), T.StructField("name", _STR))),
    T.StructField("details", _STR),
    *_fields("spread overUnder", _DOUBLE),
    *_fields("awayTeamOdds homeTeamOdds", _TEAM_ODDS),
    *_fields("open close current", _TOTAL),
)
_TEAM = _struct(*_text("id abbreviation displayName"))
_COMPETITOR = _struct(T.StructField("homeAway", _STR), T.StructField("team", _TEAM))
_SCORE_EVENT = _struct(
    *_text("id name date"),
    T.StructField(
        "competitions", T.ArrayType(_struct(T.StructField("competitors", T.ArrayType(_COMPETITOR))))
    ),
)
# ----------------------------------------------------------------------------------------------

CONTESTS_RAW = _struct(T.StructField("live_contests", T.ArrayType(CONTEST)), _LOAD)
EVENTS_RAW = _struct(T.StructField("events", T.ArrayType(EVENT)), _LOAD)
DRAFT_GROUPS_RAW = _struct(T.StructField("contest-sources", CONTEST_SOURCE), _LOAD)
CONTEST_ANALYZE_RAW = _struct(
    T.StructField("contest", _struct(*_text("contestId contestName totalEntries"))),
    T.StructField("players", T.MapType(_STR, PLAYER)),
    T.StructField("users", T.MapType(_STR, USER)),
    _LOAD,
)
LINEUPS_RAW = _struct(T.StructField("slate_id", _LONG), T.StructField("lineups", LINEUP), _LOAD)
ODDS_RAW = _struct(
    *_text("version date sport fetch_timestamp"),
    T.StructField("scoreboard_response", _struct(T.StructField("events", T.ArrayType(_SCORE_EVENT)))),
    T.StructField(
        "odds_responses",
        T.ArrayType(
            _struct(
                *_text("game_id game_name"),
                T.StructField("odds_data", _struct(T.StructField("items", T.ArrayType(_ODDS_ITEM)))),
            )
        ),
    ),
)
LINE_STATS = _struct(
    *_text("playerName team"),
    T.StructField("I_F_iceTime", _DOUBLE),
    T.StructField("iceTimeRank", _INT),
    *_text("position situation"),
)
SCHEDULE = _struct(
    T.StructField(
        "gameWeek",
        T.ArrayType(
            _struct(
                T.StructField("date", _STR),
                T.StructField("games", T.ArrayType(_struct(T.StructField("id", _LONG)))),
            )
        ),
    )
)
LEDGER = "pipeline string, sport string, table_name string, date string"

RAW = {
    "contests": CONTESTS_RAW,
    "events": EVENTS_RAW,
    "draft_groups": DRAFT_GROUPS_RAW,
    "contest_analyze": CONTEST_ANALYZE_RAW,
    "lineups": LINEUPS_RAW,
}
