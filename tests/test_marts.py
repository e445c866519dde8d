import pytest
from pyspark.sql import functions as F

from slatecraft.plans import composition, correlations, exposure, min_points, reports, team_stacks, top_users
from slatecraft.plans.top_lineups import PRESETS, LineupConfig, top_lineups, top_lineups_short
from tests.helpers import one, rows

TINY = LineupConfig("NFL", "dk_single_game", ("cpt1", "flex1"), "out", 0.5, {"cpt1": "CPT"})
LINEUP = (
    "date_id int, contest_id int, lineup_hash string, lineup_rank int, total_own double, total_salary int, "
    "lineup_percentile double, pos_cpt1 int, pos_flex1 int"
)
PLAYER = "date_id int, player_id int, roster_position string, position string, current_team string, salary int"


def players(spark):
    return spark.createDataFrame(
        [
            (1, 7, "CPT", "QB", "KC", 1500), (1, 7, "FLEX", "QB", "KC", 1000), (1, 8, "FLEX", "WR", "KC", 800),
            (1, 8, "CPT", "WR", "KC", 1200), (1, 9, None, "TE", "LV", 1), (2, 7, "CPT", "QB", "KC", 9),
        ],
        PLAYER,
    )


def test_captain_and_flex_rows_of_a_player(spark):
    lineups = spark.createDataFrame([(1, 1, "a", 1, 50.0, 2300, 0.01, 7, 8), (1, 1, "b", 9, 50.0, 2300, 0.9, 8, 7)], LINEUP)
    got = one(top_lineups(lineups, players(spark), TINY))
    assert (got["pos_cpt1_salary"], got["pos_flex1_salary"], got["pos_cpt1_real"], got["pos_flex1_player_id"]) == (1500, 800, "QB", 8)
    assert "pos_cpt1_player_id" not in top_lineups_short(lineups, players(spark), TINY).columns


def test_lineups_tied_at_a_rank(spark):
    lineups = spark.createDataFrame([(1, 1, "a", 1, 50.0, 10, 0.01, 7, None), (1, 1, "b", 1, 60.0, 20, 0.01, None, 8)], LINEUP)
    merged = one(top_lineups(lineups, players(spark), TINY))
    assert (merged["pos_cpt1_player_id"], merged["pos_flex1_player_id"], merged["total_own"]) == (7, 8, 60.0)
    assert top_lineups(lineups, players(spark), TINY, "lineup_hash").count() == 2


def test_unknown_roster_position_and_missing_players(spark):
    lineups = spark.createDataFrame([(1, 1, "a", 1, 5.0, 1, 0.01, 99, 9), (1, 2, "b", 1, 5.0, 1, 0.01, 7, 99)], LINEUP)
    assert rows(top_lineups(lineups, players(spark), TINY), "contest_id", "pos_cpt1_player_id", "pos_flex1_player_id") == [(2, 7, None)]


def test_complete_only(spark):
    lineups = spark.createDataFrame([(1, 1, "a", 1, 5.0, 1, 0.01, 7, 8), (1, 2, "b", 1, 5.0, 1, 0.01, 7, None)], LINEUP)
    config = LineupConfig("NFL", "x", ("cpt1", "flex1"), "out", 0.5, {"cpt1": "CPT"}, complete_only=True)
    assert rows(top_lineups(lineups, players(spark), config), "contest_id") == [(1,)]


@pytest.mark.parametrize("change", [{"sport": ""}, {"game_type": ""}, {"slots": ()}, {"output": ""}, {"threshold": 0}, {"threshold": 1.1}])
def test_config_is_checked(change):
    with pytest.raises(ValueError):
        LineupConfig(**{"sport": "NFL", "game_type": "g", "slots": ("a",), "output": "o", "threshold": 1, **change})


def test_presets():
    assert PRESETS["nfl_classic"].complete_only and len(PRESETS["nfl_classic"].slots) == 9
    assert PRESETS["nhl_single_game"].roles == {"cpt1": "CPT"} and PRESETS["nba_single_game"].threshold == 0.01


# --- stacks -----------------------------------------------------------------------------------


def mart(spark, lineups):
    """Line-ups as lists of (team, position) in classic slot order."""
    slots = team_stacks.CLASSIC_SLOTS
    fields = ", ".join(f"pos_{s}_team string, pos_{s}_real string" for s in slots)
    data = []
    for i, cells in enumerate(lineups, 1):
        padded = list(cells) + [(None, "QB")] * (9 - len(cells))
        data.append((1, i, 10.0 * i, 100, *[x for cell in padded for x in cell]))
    return spark.createDataFrame(data, f"contest_id int, lineup_rank int, total_own double, total_salary int, {fields}")


def test_stack_sizes_keep_repeats_in_the_averages(spark):
    big = [("A", "QB")] * 4 + [("B", "RB")] * 3 + [("C", "WR1")] * 2
    small = [("A", "TE")] * 2
    got = {r["stack_combination"]: r for r in team_stacks.stack_sizes(mart(spark, [big, small, [("Z", "K")]])).collect()}
    assert {k: r["lineup_count"] for k, r in got.items()} == {"4,3,2": 1, "4,3": 1, "4": 1, "3": 1, "2": 2}
    assert got["2"]["pct_of_lineups"] == 66.67
    # "2": once from the first line-up (own 10), twice from the second (own 20)
    assert got["2"]["avg_total_own"] == 16.67 and got["2"]["avg_lineup_rank"] == 1.7


def test_team_details_breaks_ties_by_name(spark):
    lineups = [[("A", "WR1"), ("A", "QB")], [("A", "RB"), ("A", "TE")], [("B", "K")]]
    got = one(team_stacks.team_details(mart(spark, lineups)))
    assert (got["team"], got["stack_size"], got["lineup_count"], got["position_combo"], got["position_combo_count"]) == ("A", 2, 2, "QB,WR", 1)
    assert got["pct_of_lineups"] == 66.67


def test_anchor_patterns(spark):
    qb = ("A", "QB")
    lineups = [
        [qb, ("A", "WR1"), ("A", "TE")], [qb, ("A", "WR2"), ("A", "RB")], [qb, ("A", "te"), ("B", "WR")],
        [qb, ("A", "RB2"), ("B", "WR")], [qb, ("B", "WR")], [("A", "WR"), ("A", "TE")],
    ]
    got = {r["stack_type"]: (r["lineup_count"], r["pct_of_qb_stacks"]) for r in team_stacks.anchor_patterns(mart(spark, lineups)).collect()}
    assert got == {
        "QB + WR + TE": (1, 25.0), "QB + WR (no TE)": (1, 25.0), "QB + TE (no WR)": (1, 25.0),
        "QB + RB (no pass catchers)": (1, 25.0), "QB not stacked": (1, 25.0),
    }
    strict = {r["stack_type"]: r["lineup_count"] for r in team_stacks.anchor_patterns(mart(spark, lineups), strict=True).collect()}
    assert strict["QB + RB + pass catchers"] == 1 and "QB + WR (no TE)" not in strict


def test_anchor_patterns_without_any_stack(spark):
    got = one(team_stacks.anchor_patterns(mart(spark, [[("A", "QB"), ("B", "WR")]])))
    assert (got["stack_type"], got["lineup_count"], got["pct_of_qb_stacks"]) == ("QB not stacked", 1, None)


def test_defence_patterns_show_the_combination_on_both_rows(spark):
    lineups = [[("A", "DST"), ("A", "RB")], [("A", "D"), ("A", "RB1")], [("A", "def"), ("B", "RB")], [("B", "RB")]]
    got = {r["dst_in_stack"]: r for r in team_stacks.defence_patterns(mart(spark, lineups)).collect()}
    assert (got[True]["lineup_count"], got[True]["pct_of_lineups"]) == (2, 66.67)
    assert {r["most_common_position_combo"] for r in got.values()} == {"DST,RB"}
    assert {r["combo_count"] for r in got.values()} == {2}


def test_shares_add_up_to_a_hundred(spark):
    lineups = [[("A", "DST"), ("B", "RB")], [("A", "K")], [("A", "D"), ("B", "def")]]
    table = mart(spark, lineups)
    slots = team_stacks.CLASSIC_SLOTS
    for report in (composition.defences_per_lineup(table, slots), composition.opponents_of_defence(table, slots)):
        assert abs(report.agg(F.sum("pct_of_lineups")).first()[0] - 100) < 0.05
    assert rows(composition.defences_per_lineup(table, slots), "defences", "lineup_count") == [(0, 1), (1, 1), (2, 1)]


# --- users and correlations ---------------------------------------------------------------------


def test_top_users_with_zero_rosters(spark):
    counts = ", ".join(f"lineups_in_percentile_{p} int" for p in top_users.PERCENTILES)
    users = spark.createDataFrame(
        [(1, "u", 0, 0, 0.5, 1, 1, 1, 1, 1, 1, 1, 5.0, 2.5, -2.5), (2, "v", 4, 3, 0.25, 1, 0, 0, 0, 0, 0, 0, 5.0, 2.5, -2.5)],
        f"contest_id int, user_id string, total_rosters int, unique_rosters int, max_exposure double, lineups_cashing int, {counts}, "
        "total_entry_cost double, total_winning double, roi double",
    )
    contests = spark.createDataFrame([(1, "c", 10), (2, "c", 500)], "contest_id int, slate_type string, contest_size int")
    got = rows(top_users.top_users(users, contests), "user_id", "size_category", "unique_roster_percent")
    assert got == [("u", "1_Tiny", None), ("v", "2_Small", 0.75)]


PERF = "player_id int, event_id int, event_team_id int, proj_points double, actual_points double, position string"


def pair_rows(n, constant=False, position="WR"):
    out = []
    for i in range(n):
        out.append((1, i, 1, 5.0, 7.1 if constant else float(i % 10), "QB"))
        out.append((2, i, 1, 5.0, float((i * 3) % 7), position))
    return out


@pytest.mark.parametrize("n,kept", [(50, 0), (51, 1)])
def test_only_samples_above_fifty(spark, n, kept):
    df = spark.createDataFrame(pair_rows(n), PERF)
    assert correlations.position_correlations(df).count() == kept


def test_correlation_value_and_constant_points(spark):
    df = spark.createDataFrame(pair_rows(60), PERF)
    got = one(correlations.position_correlations(df))
    df.createOrReplaceTempView("perf")
    r = spark.sql("SELECT corr(a.actual_points, b.actual_points) FROM perf a JOIN perf b ON a.event_id = b.event_id AND a.player_id < b.player_id").first()[0]
    assert abs(got["correlation"] - r) < 1e-9 and (got["position_1"], got["position_2"], got["sample_size"]) == ("QB", "WR", 60)
    constant = one(correlations.position_correlations(spark.createDataFrame(pair_rows(60, True), PERF)))
    assert constant["correlation"] is None and constant["sample_size"] == 60


def test_lowest_projection_stands_for_a_player(spark):
    df = spark.createDataFrame([(1, 1, 1, 15.0, 30.0, "CPT"), (1, 1, 1, 10.0, 20.0, "FLEX"), (1, 1, 1, 0.0, 1.0, "x")], PERF)
    assert rows(correlations.performances(df), "actual_points", "position") == [(20.0, "FLEX")]


def test_names_match_equal_or_within(spark):
    played = spark.createDataFrame(
        [(1, "Ann Lee-Ray", "LEE-RAY", "LA", "2025-01-01"), (2, "Bo Lee", "LEE", "LA", "2025-01-01"), (3, "Cy Fox", "FOX", "LA", "2025-01-02")],
        "player_id int, full_name string, clean_last_name string, current_team string, game_date string",
    ).withColumn("game_date", F.to_date("game_date"))
    lines = spark.createDataFrame(
        [("2025-01-01", "Lee", "LAK", "f1"), ("2025-01-01", "Ray", "LAK", "f2"), ("2025-01-01", "Fox", "LAK", "f3")],
        "game_date string, last_name string, team string, line string",
    )
    got = rows(correlations.with_lines(played, lines), "player_id", "line")
    assert got == [(1, "f1"), (1, "f2"), (2, "f1"), (3, None)]


# --- min points ---------------------------------------------------------------------------------

LINEUPS = "contest_id int, lineup_rank int, points double, is_cashing boolean"


def ranked(contest, n, cashing, null_at=()):
    return [(contest, r, None if r in null_at else 1000.0 - r, r <= cashing) for r in range(1, n + 1)]


def test_points_at_cutoffs_skip_missing_points(spark):
    df = spark.createDataFrame(ranked(1, 140, 20, null_at=(7,)) + ranked(2, 60, 5) + [(2, 3, 1.0, False)], LINEUPS)
    got = {r["contest_id"]: tuple(r)[1:] for r in min_points.points_at_cutoffs(df).collect()}
    assert got[1] == (994.0, 986.0, 979.0)  # rank 7 has no points, so rank 6 counts
    assert got[2] == (1.0, 994.0, 991.0)  # two line-ups at rank 3: the smaller points
    full = {r["contest_id"]: r for r in min_points.contest_results(df).collect()}
    assert tuple(full[1])[1:] == (980.0, 999.0, 20, 994.0, 986.0, 979.0)


def test_one_complete_row_per_slate(spark):
    contest = "contest_id int, contest_group_id int, cash_line int, date_id int, is_largest_by_size boolean"
    contests = spark.createDataFrame(
        [(1, 10, 3, 20250101, True), (2, 10, 4, 20250101, True), (3, 11, None, 20250102, True), (4, 12, 1, 20250103, True), (5, 10, 9, 20250101, False)],
        contest,
    )
    groups = spark.createDataFrame([(10, 100), (10, 100), (11, 101), (12, 102)], "draft_group_id int, draft_group_reference_id int")
    lineups = spark.createDataFrame(ranked(1, 20, 5) + ranked(2, 20, 5) + ranked(3, 20, 2) + ranked(4, 20, 0) + ranked(5, 20, 19), LINEUPS)
    got = rows(min_points.min_points(contests, lineups, groups), "slate_id", "cash_line", "max_lineup_rank")
    assert got == [(100, 3, 5), (101, None, 2)]  # ties to the smaller contest; no cashing line-up, no row
    assert rows(min_points.min_points(contests, lineups, groups, "2025-01-02", "2025-01-31"), "slate_id") == [(101,)]
    nothing = min_points.min_points(contests, lineups, groups, "2030-01-01", None)
    assert one(min_points.run_summary(nothing)).asDict() == {"total_records": 0, "records_with_min_points": 0, "status": "no_data"}


# --- exposure and reports -----------------------------------------------------------------------


def test_exposure_of_one_user(spark):
    entries = spark.createDataFrame([(1, "u", "a", 5), (1, "u", "b", 1), (1, "w", "a", 1), (2, "u", "a", 1)], "contest_id int, user_id string, lineup_hash string, lineup_ct int")
    contests = spark.createDataFrame([(1, 90000, 150), (2, 90000, 20)], "contest_id int, contest_size int, multi_entry_max int")
    lineups = spark.createDataFrame(
        [(1, "a", 1, 50, 1.0, 7, 8), (1, "b", 1, 40, 2.0, 8, 7)],
        "contest_id int, lineup_hash string, date_id int, total_salary int, total_own double, pos_cpt1 int, pos_flex1 int",
    )
    roster = spark.createDataFrame([(7, 1, "QB"), (8, 1, "WR"), (8, 1, "WR")], "player_id int, date_id int, position string")
    got = one(exposure.exposure(entries, contests, lineups, roster, user="u", slots=("cpt1", "flex1")))
    assert (got["min_salary"], got["max_salary"], got["max_used_count_percent"], got["max_cpt_usage_percent"]) == (40, 50, 1.0, 0.5)
    assert got["QB_position_usage_on_cpt_percent"] == 0.5 and got["TE_position_usage_on_cpt_percent"] is None


def test_player_in_two_slots_counts_once(spark):
    lineups = spark.createDataFrame([(1, "a", 9.0, True, 7, 7)], "contest_id int, lineup_hash string, points double, is_cashing boolean, pos_a int, pos_b int")
    people = spark.createDataFrame([(7, "P", 1, 1.0, 1.0)], "player_id int, full_name string, salary int, ownership double, actual_points double")
    assert one(reports.player_results(people, lineups, ["a", "b"]))["times_rostered"] == 1
