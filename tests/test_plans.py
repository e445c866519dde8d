"""Shapes of physical plans, and independence of partitioning."""

import re

import pytest
from pyspark.sql import functions as F

from checks import catalogue, tables as t
from checks.compare import difference
from slatecraft.operators import keyed

SHAPES = [
    "mrt1_captain", "mrt5_top_users", "mrt6_pair_corr", "mrt8_team_counts", "mrt9_stack_sizes", "mrt12_anchor_in_stack",
    "mrt13_min_points", "mrt15_exposure", "mrt16_size_quintiles", "doc13_results_with_totals", "doc15_ranked_users", "dds2_players",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SHAPES)
def test_no_cross_joins_and_no_python(spark, data, name):
    plan = plan_of(catalogue.QUERIES[name](spark, data))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan


@pytest.mark.parametrize("name", ["mrt1_captain", "mrt6_pair_corr", "mrt8_team_counts", "mrt13_min_points", "doc13_results_with_totals"])
def test_windows_are_partitioned(spark, data, name):
    plan = plan_of(catalogue.QUERIES[name](spark, data))
    assert "SinglePartition" not in plan.split("Subquery")[0]


def test_stacks_need_no_shuffle_after_the_mart(spark, data):
    plan = plan_of(catalogue.QUERIES["mrt8_team_counts"](spark, data))
    mart = plan_of(catalogue.QUERIES["mrt1_top_lineups"](spark, data))
    assert len(re.findall(r"Exchange hash", plan)) == len(re.findall(r"Exchange hash", mart))


def test_filters_and_columns_reach_the_files(spark, data):
    lineups = t.table(spark, data, "orders").filter(F.col("o_totalprice") > 100).select("o_orderkey")
    plan = plan_of(lineups)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_a_hot_join_key_is_split(spark):
    """One player in a third of all line-ups: adaptive execution splits the key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        cells = spark.range(0, 90000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("player_id"), F.col("id").alias("lineup")
        )
        people = spark.range(5000).select(F.col("id").alias("player_id"), (F.col("id") * 2).alias("salary"))
        joined = cells.join(people, "player_id").groupBy("lineup").agg(F.sum("salary").alias("s"))
        assert joined.agg(F.count("*"), F.sum("s")).first()[0] == 90000
        joined.collect()
        assert "skewed" in plan_of(joined) or "isSkew" in plan_of(joined) or "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["mrt5_top_users", "mrt6_pair_corr", "mrt10_team_details", "mrt13_min_points", "doc15_ranked_users"])
def test_results_do_not_depend_on_partitions(spark, data, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(catalogue.QUERIES[name](spark, data).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert difference(*results) is None


def test_counting_rows_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert sorted(tuple(r) for r in keyed.counts_joined(df, ["k"], "n").collect()) == [("a", 1, 2), ("a", 2, 2), ("b", 3, 1)]


def test_exposure_drops_other_contests_before_it_makes_lineups_distinct(spark, data):
    plan = catalogue.QUERIES["mrt15_exposure"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    semi = [i for i, line in enumerate(plan.splitlines()) if "LeftSemi" in line]
    assert semi and any("Aggregate" in line for line in plan.splitlines()[: semi[0]])


def test_player_results_make_repeats_distinct_in_the_row(spark, data):
    plan = catalogue.QUERIES["doc14_player_results"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in plan


@pytest.mark.parametrize(
    "name",
    [
        "jn2_two_keys", "jn3_role_join", "mrt1_top_lineups", "mrt1_captain", "mrt1_by_hash", "mrt3_complete", "mrt4_legacy", "mrt8_positions",
        "mrt8_team_counts", "mrt18_captain_share", "mrt19_role_count", "mrt20_opponents", "agg11_ordered_lists", "rsh2_attributes_to_rows",
        "rsh10_list_items", "rsh11_list_prefixes", "mrt15_exposure",
    ],
)
def test_players_of_all_slates_are_never_broadcast(spark, data, name):
    """Their files are small, the rows exploded from them are not."""
    lines = plan_of(catalogue.QUERIES[name](spark, data)).splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            deeper = lambda x: len(x) - len(x.lstrip(" :+-"))
            below = []
            for x in lines[i + 1 :]:
                if deeper(x) <= deeper(line):
                    break
                below.append(x)
            assert not any("Generate" in x for x in below)
