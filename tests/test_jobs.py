import json

import pytest
from pyspark.sql import functions as F

from slatecraft.plans.top_lineups import CLASSIC_SLOTS
from slatecraft.plans import jobs, normalise
from slatecraft.sources import layout, ledger, raw, schemas
from slatecraft.streaming.available_now import normalise_new_files
from tests.helpers import one, rows


def land(root, path, *documents):
    folder = root / path
    folder.mkdir(parents=True)
    (folder / "data.json").write_text("\n".join(json.dumps(d) for d in documents))


CONTEST = {"contest_id": 1, "contest_name": "c", "contest_size": "4.5", "entry_cost": "abc", "cash_line": None, "is_primary": True}


@pytest.fixture()
def landed(tmp_path):
    root = tmp_path / "staging"
    for day in ("2025-09-01", "2025-09-07", "2025-09-11"):
        land(root, f"NFL/contests/dk_classic/{day}", {"live_contests": [CONTEST, {**CONTEST, "contest_id": 2}]})
    land(root, "NFL/contests/fd_classic/2025-09-01", {"live_contests": [CONTEST]})
    return root


def run(spark, tmp_path, landed, run_date="2025-09-12"):
    places = [str(landed), str(tmp_path / "dds"), str(tmp_path / "ledger")]
    return jobs.normalise_pending(spark, *places, "NFL", "contests", run_date)


def test_settled_dates_once(spark, tmp_path, landed):
    assert run(spark, tmp_path, landed) == ["2025-09-01", "2025-09-07"]
    table = layout.read_table(spark, str(tmp_path / "dds"), "contests").withColumn("date", F.col("date").cast("string"))
    assert table.count() == 4  # only the normalised game types
    assert {tuple(r) for r in table.select("contest_size", "entry_cost", "cash_line", "is_primary", "sport", "game_type").collect()} == {
        (5, None, None, True, "NFL", "dk_classic")
    }
    assert run(spark, tmp_path, landed) == []
    assert run(spark, tmp_path, landed, "2025-09-16") == ["2025-09-11"]
    assert table.sparkSession.read.parquet(str(tmp_path / "dds" / "contests")).count() == 6
    done = ledger.read_ledger(spark, str(tmp_path / "ledger"))
    assert rows(done, "date") == [("2025-09-01",), ("2025-09-07",), ("2025-09-11",)]


def test_nothing_landed(spark, tmp_path):
    assert run(spark, tmp_path, tmp_path / "none") == []


def test_damaged_documents_keep_their_date_out(spark, tmp_path, landed):
    """No JSON, a number in quotes, a fraction for a whole number: counted, put aside, their dates not finished."""
    root = tmp_path / "staging"
    good = {"slate_id": 5, "lineups": {"lineupHash": "a", "lineupRank": 1, "lineupPlayers": {"QB1": 7}}}
    damage = {
        "2025-09-01": [json.dumps(good), json.dumps(good)[:40]],
        "2025-09-02": [json.dumps({**good, "slate_id": "5"}), json.dumps(good)],
        "2025-09-03": [json.dumps({"slate_id": 5, "lineups": {"lineupHash": "b", "lineupRank": 1.5}})],
        "2025-09-04": [json.dumps(good)],
    }
    for day, lines in damage.items():
        folder = root / f"NFL/lineups/dk_classic/{day}"
        folder.mkdir(parents=True)
        (folder / "data.json").write_text("\n".join(lines))
    places = [str(root), str(tmp_path / "dds"), str(tmp_path / "ledger")]
    assert jobs.normalise_pending(spark, *places, "NFL", "lineups", "2025-10-01") == ["2025-09-04"]
    table = spark.read.parquet(str(tmp_path / "dds/lineups")).withColumn("date", F.col("date").cast("string"))
    assert rows(table, "date", "contest_id", "pos_qb1") == [("2025-09-01", 5, 7), ("2025-09-02", 5, 7), ("2025-09-04", 5, 7)]
    aside = spark.read.parquet(str(tmp_path / "dds/_damaged/lineups")).withColumn("date", F.col("date").cast("string"))
    assert rows(aside, "date", "text") == [(day, damage[day][i]) for day, i in (("2025-09-01", 1), ("2025-09-02", 0), ("2025-09-03", 0))]
    assert rows(ledger.read_ledger(spark, str(tmp_path / "ledger")), "date") == [("2025-09-04",)]
    # mended and landed anew: the dates are still due
    for day in list(damage)[:3]:
        (root / f"NFL/lineups/dk_classic/{day}/data.json").write_text(json.dumps(good))
    assert jobs.normalise_pending(spark, *places, "NFL", "lineups", "2025-10-01") == list(damage)[:3]


def test_dates_prune_all_three_tables(spark, tmp_path):
    tables = str(tmp_path / "dds")
    for name in ("contests", "lineups", "draft_groups"):
        schema = jobs.TABLES[name].stored_schema(spark)
        empty = spark.createDataFrame([tuple(None for _ in schema)] * 3, schema)
        days = F.element_at(F.array(*[F.lit(d) for d in ("2025-01-31", "2025-02-01", "2025-03-05")]), (F.monotonically_increasing_id() % 3 + 1).cast("int"))
        filled = empty.coalesce(1).withColumns({"date": days, "sport": F.lit("NFL"), "game_type": F.lit("dk_classic")})
        filled.write.partitionBy(*layout.PARTITION).parquet(f"{tables}/{name}")
    plan = jobs.min_points_between(spark, tables, "NFL", "2025-02-10", "2025-02-20")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) >= 3
    for line in scans:
        assert "date#" in line.split("PartitionFilters: ")[1].split("PushedFilters")[0] and ">= 2025-02-01" in line
    days = ("2025-02-01", "2025-02-31")
    assert [len(jobs._of(spark, tables, n, "NFL", days=days).inputFiles()) for n in ("contests",)] and layout.month_bounds("2025-02-10", "2025-02-20") == days
    assert rows(jobs._of(spark, tables, "lineups", "NFL", days=days), "date") == [("2025-02-01",)]


def test_failed_run_is_not_recorded(spark, tmp_path, landed, monkeypatch):
    def broken(*_):
        raise RuntimeError("disk")

    monkeypatch.setattr(jobs, "replace_partitions", broken)
    with pytest.raises(RuntimeError):
        run(spark, tmp_path, landed)
    assert ledger.read_ledger(spark, str(tmp_path / "ledger")).count() == 0


def test_stream_reads_each_file_once(spark, tmp_path, landed):
    def stream():
        query = normalise_new_files(spark, str(landed), "NFL", "contests", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "out" / "contests")).count()

    assert stream() == 6
    land(landed, "NFL/contests/dk_classic/2025-09-12", {"live_contests": [CONTEST]})
    assert stream() == 7


def test_stream_gives_what_the_ledger_job_gives(spark, tmp_path, landed):
    """A file that lands late for a date adds to it; game types outside the jobs stay out."""
    out = tmp_path / "streamed"

    def stream():
        normalise_new_files(spark, str(landed), "NFL", "contests", str(out), str(tmp_path / "checkpoint")).awaitTermination(120)

    stream()
    late = landed / "NFL/contests/dk_classic/2025-09-11/late.json"
    late.write_text(json.dumps({"live_contests": [CONTEST | {"contest_id": 990}]}) + "\n")
    land(landed, "NFL/contests/dk_tiers/2025-09-11", {"live_contests": [CONTEST]})
    stream()
    run(spark, tmp_path, landed, "2025-12-01")
    by_job = spark.read.parquet(str(tmp_path / "dds" / "contests"))
    by_stream = spark.read.parquet(str(out / "contests")).select(by_job.columns)
    assert by_stream.where("contest_id = 990").count() == 1
    assert by_stream.exceptAll(by_job).isEmpty() and by_job.exceptAll(by_stream).isEmpty()


def test_refresh_today_and_skip_finished(spark):
    candidates = spark.createDataFrame([("dds", "NFL", "t", d) for d in ("2025-01-01", "2025-01-02", "2025-01-03")], schemas.LEDGER)
    done = candidates.filter(F.col("date") != "2025-01-02")
    got = ledger.pending_or_today(candidates, done, F.lit("2025-01-03").cast("date"))
    assert rows(got, "date") == [("2025-01-02",), ("2025-01-03",)]


def days_of(spark, path):
    return [r["date"] for r in ledger.read_ledger(spark, path).orderBy("date").collect()]


def entry(spark, *days):
    return spark.createDataFrame([("dds", "NFL", "t", d) for d in days], schemas.LEDGER)


def test_two_runs_at_once_mark_each_date_once(spark, tmp_path, monkeypatch):
    """The second run marks between the first one's reading and writing: the first must see it and add only the rest."""
    path, create, calls = str(tmp_path / "ledger"), ledger._create, []

    def late(session, where, name, found):
        calls.append(name)
        if len(calls) == 1:
            assert create(session, where, name, entry(session, "2025-01-01", "2025-01-02").collect())
        return create(session, where, name, found)

    monkeypatch.setattr(ledger, "_create", late)
    ledger.mark(spark, path, entry(spark, "2025-01-02", "2025-01-03"))
    assert calls == ["0000000001.json", "0000000002.json"]
    assert days_of(spark, path) == ["2025-01-01", "2025-01-02", "2025-01-03"]
    assert (tmp_path / "ledger/0000000002.json").read_text().count("\n") == 1
    assert not [p for p in (tmp_path / "ledger").iterdir() if not p.name.endswith((".json", ".crc"))]


def test_many_runs_in_threads(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "ledger")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: ledger.mark(spark, path, entry(spark, "2025-01-01", f"2025-02-{i + 1:02d}")), range(6)))
    assert days_of(spark, path) == ["2025-01-01", *[f"2025-02-{i + 1:02d}" for i in range(6)]]


def test_entries_are_summed_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "SUM_AFTER", 3)
    path, days = str(tmp_path / "ledger"), [f"2025-01-{i:02d}" for i in range(1, 9)]
    for i, day in enumerate(days):
        ledger.mark(spark, path, entry(spark, day, days[0]))
        assert days_of(spark, path) == days[: i + 1]
    entries, sums = ledger._numbers(spark, path)
    assert sums == [3, 6] and entries == [4, 5, 6, 7, 8]


def test_month_folders():
    assert layout.month_patterns("2024-11-20", "2025-02-01") == ["2024-11-*", "2024-12-*", "2025-01-*", "2025-02-*"]
    assert layout.month_patterns("2025-02-01", "2025-02-20") == ["2025-02-*"]
    assert layout.month_patterns("2025-02-01", None) == ["*"]


def test_last_month(spark):
    assert jobs.last_month(spark, "2025-03-15") == ("2025-02-01", "2025-02-28")


# --- normalisers --------------------------------------------------------------------------------


def parse(spark, schema, *documents):
    texts = spark.createDataFrame([(json.dumps(d),) for d in documents], "t string")
    return texts.select(F.from_json("t", schema).alias("d")).select("d.*")


def test_users_and_their_lineups(spark):
    entry = {"userId": "u1", "totalRosters": 2, "roi": 1.5, "lineups": {"h1": {"lineupHash": "h1", "lineupCt": 2}, "x": {"lineupCt": 1}}}
    document = {"contest": {"contestId": "77"}, "users": {"u1": entry, "u2": {"userId": "u2", "lineups": {}}}}
    source = parse(spark, schemas.CONTEST_ANALYZE_RAW, document, document)
    assert rows(normalise.users(source), "contest_id", "user_id", "total_rosters") == [(77, "u1", 2), (77, "u2", None)]
    assert rows(normalise.user_lineups(source)) == [(77, "u1", "h1", 2)] * 2


def test_lineups_with_different_slots_and_empty_details(spark):
    first = {"slate_id": 5, "lineups": {"lineupHash": "a", "lineupPlayers": {"QB1": 7}, "teamStacks": [], "entryNameList": ["n"]}}
    second = {"slate_id": 5, "lineups": {"lineupHash": "b", "lineupPlayers": {"QB1": 7, "RB1": 8}, "lineupTrends": {"x": True}}}
    got = normalise.lineups(parse(spark, schemas.LINEUPS_RAW, first, second, first), ["qb1", "rb1"])
    columns = ("lineup_hash", "pos_qb1", "pos_rb1", "team_stacks", "entry_name_list", "lineup_trends")
    assert rows(got, *columns) == [("a", 7, None, None, '["n"]', None), ("b", 7, 8, None, None, '{"x":true}')]


def test_draft_groups_by_source(spark):
    group = {"id": 1, "contest_start_date": "2025-09-07 17:00:00", "contest_end_date": "0001-01-01 00:00:00", "draft_group_id": 9, "sport": {"id": 1}}
    documents = [{"contest-sources": {"id": i, "source_name": f"s{i}", "draft_groups": [group, group]}} for i in (3, 4, 8)]
    got = normalise.draft_groups(parse(spark, schemas.DRAFT_GROUPS_RAW, *documents).withColumn("date", F.lit("2025-09-07")))
    assert rows(got, "game_type", "draft_group_reference_id", "date_id") == [("dk_classic", 9, 20250907), ("dk_single_game", 9, 20250907)]


def test_lines(spark):
    stats = spark.createDataFrame(
        [
            ("Lee - Ray-Fox", "LA", 1.0, "line", "5on5"), ("A-B", "LA", 5.0, "line", "5on5"), ("C-D", "LA", 4.0, "pairing", "5on5"),
            ("E-F", "LA", 3.0, "pairing", "5on5"), ("G-H", "LA", -1.0, "G", "5on5"), ("I", "LA", 0.0, "G", "5on5"), ("J-K", "LA", 1.0, "line", "all"),
        ],
        "playerName string, team string, iceTimeRank double, position string, situation string",
    ).withColumn("game_date", F.lit("2025-01-01"))
    got = rows(normalise.lines(stats), "last_name", "line")
    assert got == [("E", "d3"), ("F", "d3"), ("Fox", "f1"), ("G-H", "G1"), ("Lee", "f1"), ("Ray", "f1")]


def test_odds_documents(spark, tmp_path):
    item = lambda provider, opened: {
        "provider": {"id": provider},
        "homeTeamOdds": {"open": {"pointSpread": {"american": opened}}, "close": {"pointSpread": {"american": "-3.5"}}},
    }
    document = {
        "date": "2025-11-20", "sport": "NBA", "fetch_timestamp": "t",
        "scoreboard_response": {"events": [{"id": "1", "name": "A at B", "competitions": [{"competitors": [
            {"homeAway": "home", "team": {"displayName": "B"}}, {"homeAway": "away", "team": {"displayName": "A"}}]}]}]},
        "odds_responses": [
            {"game_id": "1", "odds_data": {"items": [item("58", "+2.5"), item("59", "+9")]}},
            {"game_id": "2", "odds_data": None},
        ],
    }
    (tmp_path / "odds.json").write_text(json.dumps(document, indent=2))
    odds = raw.read_documents(spark, str(tmp_path / "odds.json"), schemas.ODDS_RAW)
    assert rows(normalise.odds_games(odds), "game_id", "home_team", "away_team") == [("1", "B", "A")]
    assert rows(normalise.game_names(odds)) == [("1", "A at B"), ("2", "Unknown")]
    moves = normalise.line_movements(normalise.pregame_odds(odds)).filter(F.col("movement_type") == "spread")
    assert tuple(one(moves)) == ("1", "spread", 2.5, -3.5, -6.0, True)
    assert rows(normalise.odds_load_summary(odds), "games", "games_with_odds") == [(1, 1)]


def test_marts_from_landed_files(spark, tmp_path):
    """Landed documents to tables to all marts, through the jobs."""
    root, day = tmp_path / "staging", "2025-09-07"
    source = {"id": 4, "source_name": "s", "draft_groups": [{"id": 10, "draft_group_id": 100}]}
    land(root, f"NFL/draft_groups/{day}", {"contest-sources": source})
    contest = {"contest_id": 1, "contest_size": 100, "is_largest_by_size": "true", "contest_group_id": 10, "date_id": 20250907}
    land(root, f"NFL/contests/dk_classic/{day}", {"live_contests": [contest]})
    slots = CLASSIC_SLOTS
    people = {
        str(i): {"playerId": i, "position": "QB" if s == "qb1" else s[:2].upper(), "rosterPosition": "X", "currentTeam": f"T{i % 3}",
                 "salary": 100, "eventId": 1, "eventTeamId": i % 2, "projPoints": 1.5, "actualPoints": i}
        for i, s in enumerate(slots)
    }
    user = {"userId": "u", "totalRosters": 1, "uniqueRosters": 1, "lineups": {}}
    land(root, f"NFL/contest_analyze/dk_classic/{day}", {"contest": {"contestId": "1"}, "players": people, "users": {"u": user}})
    lineups = [
        {"slate_id": 1, "lineups": {"lineupHash": f"h{r}", "lineupRank": r, "points": 100.0 - r, "isCashing": r <= 5, "lineupPercentile": r / 100,
                                    "totalOwn": 1.0, "totalSalary": 9, "lineupPlayers": {s.upper(): i for i, s in enumerate(slots)}}}
        for r in range(1, 21)
    ]
    land(root, f"NFL/lineups/dk_classic/{day}", *lineups)
    tables, marts = str(tmp_path / "dds"), str(tmp_path / "marts")
    for table in jobs.TABLES:
        assert jobs.normalise_pending(spark, str(root), tables, str(tmp_path / "ledger"), "NFL", table, "2025-10-01") == [day]
    from slatecraft.plans.top_lineups import PRESETS

    config = PRESETS["nfl_classic"]
    jobs.top_lineups_job(spark, tables, marts, config)
    got = one(spark.read.parquet(f"{marts}/{config.output}"))
    assert (got["lineup_rank"], got["pos_qb1_real"], got["pos_qb1_team"]) == (1, "QB", f"T{slots.index('qb1') % 3}")
    jobs.team_stacks_job(spark, marts, config)
    assert rows(spark.read.parquet(f"{marts}/team_stacks/NFL/dk_classic/stack_sizes"), "stack_combination") == [("3",), ("3,3",), ("3,3,3",)]
    jobs.top_users_job(spark, tables, marts, "NFL")
    assert rows(spark.read.parquet(f"{marts}/top_users/NFL"), "user_id", "slate_type", "size_category") == [("u", "dk_classic", "1_Tiny")]
    jobs.position_correlations_job(spark, tables, marts, "NFL")
    assert spark.read.parquet(f"{marts}/position_correlations/NFL").count() == 0
    summary = jobs.min_points_job(spark, tables, marts, "NFL", "2025-09-01", "2025-09-30")
    assert summary == {"total_records": 1, "records_with_min_points": 1, "status": "success"}
    assert json.loads(spark.read.text(f"{marts}/min_points/NFL/data").first()[0])["top_15_percentile_points"] == 97.0


def test_lines_of_all_landed_days(spark, tmp_path):
    assert jobs.lines_job(spark, str(tmp_path / "none"), str(tmp_path / "lines")) is False
    stats = spark.createDataFrame([("A-B", "LAK", 1.0, 1, "line", "5on5")], schemas.LINE_STATS)
    assert layout.has_rows(stats) and not layout.has_rows(stats.filter("team = 'x'"))
    stats.write.parquet(str(tmp_path / "stats/players/2025-01-01"))
    assert jobs.lines_job(spark, str(tmp_path / "stats"), str(tmp_path / "lines")) is True
    stored = spark.read.parquet(str(tmp_path / "lines"))
    assert rows(stored) == [("2025-01-01", "A", "LAK", "f1"), ("2025-01-01", "B", "LAK", "f1")]


def test_line_correlations_job(spark, tmp_path):
    """Two players of one line in sixty events."""
    people = spark.createDataFrame(
        [
            (p, e, 1, 2.0, float((e * p) % 7), "LW", f"X {n}", n, "LA", "NHL", "2025-01-01", "dk_classic")
            for e in range(60) for p, n in ((1, "Lee"), (2, "Ray"))
        ],
        "player_id int, event_id int, event_team_id int, proj_points double, actual_points double, position string, "
        "full_name string, last_name string, current_team string, sport string, date string, game_type string",
    )
    people.write.partitionBy("sport", "game_type", "date").parquet(str(tmp_path / "dds/players"))
    lines = [("2025-01-01", "Lee", "LAK", "f1"), ("2025-01-01", "Ray", "LAK", "f1")]
    spark.createDataFrame(lines, "game_date string, last_name string, team string, line string").write.parquet(str(tmp_path / "lines"))
    jobs.line_correlations_job(spark, str(tmp_path / "dds"), str(tmp_path / "marts"), str(tmp_path / "lines"))
    got = one(spark.read.parquet(str(tmp_path / "marts/line_correlations/NHL")))
    assert (got["position_1"], got["line_2"], got["team_relationship"], got["sample_size"]) == ("W", "f1", "same_team", 60)


def test_odds_files_hold_many_documents(spark, tmp_path, monkeypatch):
    """As many files as a share of the events, none of one document each."""
    from checks import storage

    monkeypatch.setattr(storage, "shared_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(storage, "_EVENTS_PER_FILE", 100, raising=False)
    kinds = F.element_at(F.array(*map(F.lit, ("view", "click", "error"))), (F.col("id") % 3 + 1).cast("int"))
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    events = spark.range(400).select(
        F.col("id").alias("event_id"), stamp.alias("ts"), (F.col("id") % 50).alias("user_id"), kinds.alias("event_type"), F.col("id").cast("double").alias("value")
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    found = storage.src16(spark, str(tmp_path)).collect()
    first = {f"{i % 50}-{('view', 'click', 'error')[i % 3]}": float(i) for i in reversed(range(400)) if i % 3 < 2}
    assert {r["game_id"]: r["spread_open"] for r in found} == first and len(found) == len(first)
    assert len(list((tmp_path / "src16").glob("*.txt"))) <= 4
