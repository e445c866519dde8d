import random
import re
import statistics
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slatecraft.operators import keyed, pairs, quality, ranking, reshape
from slatecraft.plans.correlations import position_correlations
from tests.helpers import one, rows


def test_top1_is_the_same_for_any_partitioning(spark):
    data = [(k % 5, k % 7, k) for k in range(200)]
    df = spark.createDataFrame(data, "k int, o int, v int")
    expected = rows(keyed.top1_per_key(df, ["k"], [F.col("o")]))
    assert expected == [(k, 0, min(v for kk, o, v in data if kk == k and o == 0)) for k in range(5)]
    assert rows(keyed.top1_per_key(df.repartition(16), ["k"], [F.col("o")])) == expected


def test_symmetric_difference(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    right = spark.createDataFrame([("b",), ("c",)], "c string")
    assert rows(keyed.symmetric_difference(left, right, "c")) == [("a", "left"), ("c", "right")]


def test_slots_there_and_back(spark):
    wide = spark.createDataFrame([(1, 10, None), (2, None, 30)], "k int, pos_a int, pos_b int")
    long = reshape.unpivot_slots(wide, ["k"], ["a", "b"])
    assert long.count() == 4  # empty slots stay
    cells = reshape.pivot_cells(F.col("pos_slot"), ["a", "b"], {"id": F.col("player_id")})
    assert rows(long.groupBy("k").agg(*cells)) == [(1, 10, None), (2, None, 30)]
    assert reshape.unpivot_filled(wide, ["k"], ["pos_a", "pos_b"], "s", "v").count() == 2


def test_slot_names_ignore_case(spark):
    df = spark.createDataFrame([({"CPT1": 1},), ({"flex1": 2, "cpt1": 3},)], "m map<string,int>")
    assert reshape.slot_names(df, "m") == ["cpt1", "flex1"]
    got = reshape.with_slots(df, "m", ["cpt1", "flex1"])
    assert rows(got) == [(1, None), (3, 2)]


def brute_ntile(values, tiles):
    ordered = sorted(values, key=lambda v: (v is None, v if v is not None else 0))
    small, extra = divmod(len(ordered), tiles)
    out, start = [], 0
    for b in range(tiles):
        size = small + (b < extra)
        part = ordered[start : start + size]
        known = [v for v in part if v is not None]
        if part:
            out.append((b + 1, size, min(known, default=None), max(known, default=None)))
        start += size
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 30)), min_size=1, max_size=60), st.integers(2, 6), st.integers(2, 9))
def test_ntile_matches_sorting(spark, values, tiles, blocks):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = ranking.ntile_summary(df, "v", tiles, blocks).select("bucket", "n", "min_value", "max_value")
    assert sorted(map(tuple, got.collect())) == sorted(brute_ntile(values, tiles))


@pytest.mark.parametrize("blocks", [2, 7, 40, None])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_with_a_hot_key_ties_and_nulls(spark, blocks, descending):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 11}", None if i % 37 == 0 else rng.choice([1.5, 2.0, rng.random()])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, v double")
    df.createOrReplaceTempView("ranked")
    way = "DESC" if descending else "ASC"
    expected = spark.sql(f"SELECT *, cast(rank() OVER (PARTITION BY k ORDER BY v {way} NULLS LAST) AS bigint) AS r FROM ranked")
    assert rows(ranking.add_rank(df, "v", ["k"], "r", descending, blocks)) == rows(expected)


def test_row_numbers_follow_the_whole_order(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(20)]), i, rng.choice("ab")) for i in range(500)]
    df = spark.createDataFrame(data, "v int, id int, _place string").repartition(7)
    got = ranking.add_row_number(df, [F.desc_nulls_last("v"), F.asc("id")], "place").collect()
    expected = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["place"])] == expected
    assert sorted(r["place"] for r in got) == list(range(1, 501))
    assert ranking.add_row_number(df.limit(0), [F.asc("id")], "place").count() == 0


def brute_pairs(data):
    """(class 1, class 2, relation) -> rows of both sides, by looking at every pair."""
    events = defaultdict(list)
    for e, p, team, c, x in data:
        if e is not None and p is not None:
            events[e].append((p, team, c, x))
    found = defaultdict(list)
    for members in events.values():
        for a in members:
            for b in members:
                if a[0] < b[0]:
                    same = a[1] is not None and a[1] == b[1]
                    found[(a[2], b[2], "same_team" if same else "opponent_team")].append((a[3], b[3]))
    return found


@pytest.mark.parametrize("bits", [2, 4, 16])
def test_pair_moments_match_all_pairs(spark, bits):
    """One event holds a third of the rows; ids repeat, spread wide, and go below zero."""
    rng = random.Random(bits)
    data = []
    for i in range(240):
        event = 1 if i % 3 == 0 else rng.randrange(20)
        data.append((
            None if i % 50 == 49 else event, rng.choice([rng.randrange(-40, 60), rng.randrange(1000)]),
            None if i % 41 == 0 else rng.randrange(2), rng.choice(["QB", "WR", "TE"]),
            None if i % 13 == 0 else float(rng.randrange(30)),
        ))
    df = spark.createDataFrame(data, "e int, p int, t int, c string, x double")
    got = pairs.pair_moments(df, "e", "p", "t", ["c"], F.col("x"), bits=bits).collect()
    expected = brute_pairs(data)
    assert {(r["c_1"], r["c_2"], r["team_relationship"]) for r in got} == set(expected)
    for r in got:
        both = expected[(r["c_1"], r["c_2"], r["team_relationship"])]
        known = [(x, y) for x, y in both if x is not None and y is not None]
        assert r["pairs"] == len(both) and r["both"] == len(known)
        x, y = [x for x, _ in known], [y for _, y in known]
        every_x, every_y = [x for x, _ in both if x is not None], [y for _, y in both if y is not None]
        assert (r["known_1"], r["known_2"]) == (len(every_x), len(every_y))
        for mean, m2, values in (("mean_1", "m2_1", x), ("mean_2", "m2_2", y), ("all_mean_1", "all_m2_1", every_x), ("all_mean_2", "all_m2_2", every_y)):
            if values:
                assert r[mean] == pytest.approx(statistics.fmean(values), rel=1e-12)
                assert r[m2] == pytest.approx(statistics.pvariance(values) * len(values), rel=1e-9, abs=1e-9)
        if known:
            mx, my = statistics.fmean(x), statistics.fmean(y)
            assert r["products"] == pytest.approx(sum((a - mx) * (b - my) for a, b in known), rel=1e-9, abs=1e-8)


def test_pair_moments_move_rows_of_ordinary_events_once(spark):
    """However wide the ids are spread: rows go to their event, not to ranges of several levels."""
    rows = [(e, (e * 7919 + k * 104729) % 2**40, k % 2, "A" if k < 2 else "B", float(e * k % 11)) for e in range(60) for k in range(4)]
    df = spark.createDataFrame(rows, "e long, p long, t int, c string, x double").repartition(4, "p", "e", "t")
    found = pairs.pair_moments(df, "e", "p", "t", ["c"], F.col("x"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # dealt by the caller, dealt by event, sums by cell
    assert len(re.findall("Exchange hashpartitioning", plan)) == 3
    expected = brute_pairs([(e, p, t, c, x) for e, p, t, c, x in rows])
    assert {(r["c_1"], r["c_2"], r["team_relationship"]): r["pairs"] for r in found.collect()} == {k: len(v) for k, v in expected.items()}


def correlations_of(spark, data):
    df = spark.createDataFrame(data, "event_id int, player_id int, event_team_id int, position string, actual_points double")
    found = position_correlations(df.withColumn("proj_points", F.lit(1.0)), more_than=1)
    return {(r["position_1"], r["position_2"]): r["correlation"] for r in found.collect()}


@pytest.mark.parametrize("outlier", [("K", 0.0), ("A", 0.0), ("B", -3e12)])
def test_an_outlier_elsewhere_changes_nothing(spark, outlier):
    """Values near ten million, and a single one far away that no pair of the cell holds."""
    rng = random.Random(7)
    data = []
    for event in range(100):
        x = rng.gauss(0, 1)
        data += [(event, 1, 0, "A", 1e7 + x), (event, 2, 0, "B", 1e7 + x + rng.gauss(0, 0.5))]
    cls, value = outlier
    alone = [(1000, 1, 0, cls, value), (1000, 2, 1, "other", 1.0)]
    first, second = ([x for _, _, _, c, x in data if c == k] for k in "AB")
    expected = statistics.correlation(first, second)
    assert correlations_of(spark, data + alone)[("A", "B")] == pytest.approx(expected, abs=1e-9)
    assert correlations_of(spark, data)[("A", "B")] == pytest.approx(expected, abs=1e-9)


def test_no_spread_is_null_whatever_the_rounding(spark):
    data = [(e, p, 0, c, 0.1 if c == "A" else float(e)) for e in range(97) for p, c in ((1, "A"), (2, "B"))]
    assert correlations_of(spark, data) == {("A", "B"): None}


def test_an_id_that_repeats_counts_every_row_once(spark):
    """A hundred thousand rows of one id in one event are a single row of the window."""
    many = spark.range(100_000).select(F.lit(1).alias("e"), F.lit(5).alias("p"), F.lit(0).alias("t"), F.lit("A").alias("c"), (F.col("id") % 10).cast("double").alias("x"))
    few = spark.createDataFrame([(1, 9, 0, "B", 1.0), (1, 3, 0, "B", 4.0)], many.schema)
    found = {(r["c_1"], r["c_2"]): r for r in pairs.pair_moments(many.unionByName(few), "e", "p", "t", ["c"], F.col("x")).collect()}
    assert {k: v["pairs"] for k, v in found.items()} == {("A", "B"): 100_000, ("B", "A"): 100_000, ("B", "B"): 1}
    assert found[("A", "B")]["mean_1"] == pytest.approx(4.5) and found[("B", "A")]["m2_2"] == pytest.approx(825_000)


def test_large_values_close_to_each_other_correlate(spark):
    """Ten million and a digit: the spread is a millionth of the size, and still there."""
    rng = random.Random(3)
    data = [(e, p, 0, c, 1e7 + rng.randrange(10)) for e in range(100) for p, c in ((1, "A"), (2, "B"))]
    df = spark.createDataFrame(data, "event_id int, player_id int, event_team_id int, position string, actual_points double")
    got = one(position_correlations(df.withColumn("proj_points", F.lit(1.0)), more_than=1))
    first, second = ([x for _, _, _, c, x in data if c == k] for k in "AB")
    assert abs(got["correlation"] - statistics.correlation(first, second)) < 1e-9


def test_profile_of_a_small_table(spark):
    df = spark.createDataFrame([(1, "a"), (3, None), (None, "b")], "n int, s string")
    got = {r["column_name"]: r for r in quality.profile(df).collect()}
    assert (got["n"]["smallest"], got["n"]["largest"], got["n"]["mean"], got["n"]["row_count"]) == ("1", "3", 2.0, 3)
    assert got["s"]["mean"] is None and got["s"]["null_pct"] == 33.33
    sketches = {r["column_name"]: r for r in quality.profile_sketches(df).collect()}
    assert sketches["n"]["approx_distinct"] == 2 and sketches["s"]["q50"] is None


def test_sketches_by_day_merge_to_the_whole(spark):
    """Within the stated errors of exact values, also for a column without numbers and one without values."""
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") % 10).cast("string").alias("day"), (F.col("id") * 7919 % n).alias("v"),
        (F.col("id") % 501).cast("string").alias("s"), F.lit(None).cast("double").alias("none"),
    )
    stored = quality.sketches(df, ["day"])
    assert stored.count() == 30
    found = {r["column_name"]: r for r in quality.estimates(quality.merged(stored)).collect()}
    assert all(r["row_count"] == n for r in found.values()) and found["none"]["missing"] == n
    assert abs(found["v"]["approx_distinct"] - n) <= quality.DISTINCT_ERROR * n
    assert abs(found["s"]["approx_distinct"] - 501) <= quality.DISTINCT_ERROR * 501
    for label, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert abs(found["v"][label] / n - q) <= quality.RANK_ERROR
    assert found["s"]["q50"] is None and found["none"]["q50"] is None


def test_profile_of_columns_with_similar_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, a_b int")
    assert {r["column_name"]: r["largest"] for r in quality.profile(df).collect()} == {"a": "1", "a_b": "2"}


def test_order_check(spark):
    df = spark.createDataFrame([(3.0, 2.0, 1.0), (1.0, 2.0, 0.0), (None, 1.0, 2.0)], "a double, b double, c double")
    assert rows(quality.not_descending(df, ["a", "b", "c"])) == [(1.0, 2.0, 0.0)]
