from pyspark.sql import functions as F

from slatecraft.functions import casting, dates, metrics, numeric, stacks, text
from tests.helpers import one, rows


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_integers_from_text_round_and_never_fail(spark):
    df = spark.createDataFrame([("4.5",), ("2.4",), ("-2.5",), ("abc",), (None,), ("7",), ("99999999999",)], "t string")
    got = [r["v"] for r in df.select(casting.int_from_text(F.col("t")).alias("v")).collect()]
    assert got == [5, 2, -3, None, None, 7, None]
    assert value(spark, casting.int_from_text(F.lit("9007199254740993"), "bigint")) == 9007199254740993


def test_integers_from_doubles_round_half_to_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (2.6,)], "d double")
    assert [r["v"] for r in df.select(casting.int_from_double(F.col("d")).alias("v")).collect()] == [2, 4, -2, 3]


def test_sentinel_timestamp_survives(spark):
    stamp = casting.timestamp_from_text(F.lit("0001-01-01 00:00:00")).cast("string")
    assert value(spark, stamp) == "0001-01-01 00:00:00"
    assert value(spark, casting.bool_from_text(F.lit("true"))) is True
    assert value(spark, casting.bool_from_text(F.lit("maybe"))) is None


def test_rounding_uses_the_binary_value(spark):
    assert value(spark, numeric.round_to(F.lit(1.005), 2)) == 1.0
    assert value(spark, numeric.round_to(F.lit(2.675), 2)) == 2.68
    assert value(spark, numeric.ratio(F.lit(1), F.lit(0))) is None


def test_correlation_of_constants_is_null(spark):
    df = spark.createDataFrame([(1.1, 2.0), (1.1, 3.0), (1.1, 5.0)], "x double, y double")
    assert one(df.agg(numeric.correlation(F.col("x"), F.col("y")).alias("r")))["r"] is None
    r = numeric.correlation_from_moments(F.lit(0.0), F.lit(2.0), F.lit(0.0))
    assert one(df.limit(1).select(r.alias("r")))["r"] is None


def test_positions(spark):
    df = spark.createDataFrame([("WR1",), ("WR12",), ("def",), ("D",), ("D1",), ("qb",), (None,)], "p string")
    got = [r["v"] for r in df.select(text.normalise_position(F.col("p")).alias("v")).collect()]
    assert got == ["WR", "WR2", "DST", "DST", "D", "QB", None]


def test_size_tiers_at_their_borders(spark):
    df = spark.createDataFrame([(318,), (319,), (4444,), (16646,), (79270,), (79271,), (None,)], "n int")
    got = [r["v"] for r in df.select(text.size_tier(F.col("n")).alias("v")).collect()]
    assert got == ["1_Tiny", "2_Small", "2_Small", "3_Medium", "4_Large", "5_Massive", "5_Massive"]


def test_name_patterns(spark):
    df = spark.createDataFrame([("JOHN SMITH-JONES", "SMITH"), ("A B", "C"), ("AXB", "A_B")], "f string, p string")
    got = [r["v"] for r in df.select(text.name_within(F.col("f"), F.col("p")).alias("v")).collect()]
    assert got == [True, False, True]


def test_prefixes_and_combinations(spark):
    df = spark.createDataFrame([([4, 3, 2],), ([2],), ([],)], "a array<bigint>")
    got = [r["v"] for r in df.select(stacks.stack_combinations(F.col("a")).alias("v")).collect()]
    assert got == [["4,3,2"] * 3 + ["4", "4,3", "4", "3", "2"], ["2", "2"], []]
    repeated = one(df.limit(1).select(stacks.with_repeats(stacks.stack_combinations(F.col("a"))).alias("v")))["v"]
    assert {r["item"]: r["times"] for r in repeated} == {"4,3,2": 3, "4": 2, "4,3": 1, "3": 1, "2": 1}


def test_date_helpers(spark):
    df = spark.createDataFrame([("2025-03-15",)], "d string").select(F.to_date("d").alias("d"))
    first, last = dates.previous_month(F.col("d"))
    got = one(df.select(first.alias("a"), last.alias("b"), dates.date_id(F.col("d")).alias("k")))
    assert (str(got["a"]), str(got["b"]), got["k"]) == ("2025-02-01", "2025-02-28", 20250315)
    months = one(df.select(dates.months_touched(F.lit("2024-11-20").cast("date"), F.col("d")).alias("m")))["m"]
    assert [str(m)[:7] for m in months] == ["2024-11", "2024-12", "2025-01", "2025-02", "2025-03"]
    ids = spark.createDataFrame([(20250101,), (20250131,), (20250201,)], "k int")
    assert rows(ids.filter(dates.within_ids(F.col("k"), "2025-01-01", "2025-01-31"))) == [(20250101,), (20250131,)]
    assert ids.filter(dates.within_ids(F.col("k"), None, None)).count() == 3
    assert value(spark, dates.path_part(F.lit("s3://b/dds/NFL/players/dk_classic/2025-01-01/data.parquet"), -3)) == "dk_classic"


def test_odds_text(spark):
    df = spark.createDataFrame([("+110",), ("-3.5",), ("EVEN",), (None,)], "o string")
    assert [r["v"] for r in df.select(metrics.american_number(F.col("o")).alias("v")).collect()] == [110.0, -3.5, None, None]


def test_diversity_classes(spark):
    df = spark.createDataFrame([(10, 10), (9, 10), (8, 10), (6, 10), (5, 10), (0, 0)], "u int, t int")
    got = [r["v"] for r in df.select(metrics.diversity_class(F.col("u"), F.col("t")).alias("v")).collect()]
    assert got == ["Full Diversity", "High Diversity", "Medium Diversity", "Medium Diversity", "Low Diversity", "Full Diversity"]
