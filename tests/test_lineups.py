"""Line-ups are normalised without loss."""

import json

from slatecraft.operators.reshape import slot_names
from slatecraft.plans import normalise
from slatecraft.sources import ledger, schemas


def raw(spark, *docs):
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    from pyspark.sql import functions as F

    rows = lines.select(F.from_json("value", schemas.LINEUPS_RAW).alias("r")).select("r.*")
    return rows.withColumns({"sport": F.lit("NBA"), "game_type": F.lit("dk_classic"), "date": F.lit("2025-09-07")})


def lineup(hash_, points, load, **slots):
    return {"slate_id": 1, "load_ts": load, "lineups": {"lineupHash": hash_, "points": points, "lineupPlayers": slots}}


def test_slots_nulls_and_repeats(spark):
    rows = raw(
        spark,
        lineup("a", 1.0, "2025-09-07 01:00:00", PG=1, UTIL=2),
        lineup("a", 2.0, "2025-09-07 02:00:00", PG=1, UTIL=2),
        lineup(None, 3.0, "2025-09-07 01:00:00", TE=5),
        lineup(None, 3.0, "2025-09-07 01:00:00", TE=5),
        lineup("b", 4.0, "2025-09-07 01:00:00", pg=7, PG=8),
    )
    slots = slot_names(rows, "lineups.lineupPlayers")
    assert slots == ["pg", "te", "util"]
    found = normalise.lineups(rows, slots).collect()
    assert sorted((r["lineup_hash"] or "", r["points"], r["pos_pg"], r["pos_te"]) for r in found) == [
        ("", 3.0, None, 5), ("", 3.0, None, 5), ("a", 2.0, 1, None), ("b", 4.0, 8, None),
    ]


def test_stray_folder_names_are_left_out(spark):
    from pyspark.sql import functions as F

    days = spark.createDataFrame([("2025-09-01",), ("_SUCCESS",)], "date string")
    assert [r["date"] for r in ledger.settled(days, F.lit("2025-10-01").cast("date"), 5).collect()] == ["2025-09-01"]
