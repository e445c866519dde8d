"""Analyst reports and data checks on derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import marts, tables as t
from checks.registry import query
from slatecraft.functions.numeric import round_to
from slatecraft.operators import quality
from slatecraft.operators.keyed import symmetric_difference
from slatecraft.plans import min_points, reports
from slatecraft.plans.top_lineups import SINGLE_GAME_SLOTS
from slatecraft.session import shared_folder

R4 = "round(({0}) * 10000) / 10000"
R6 = marts.R6
DAY, FIRST, LAST = 19970101, 19960101, 19981231


@query(
    "doc1_slates_on_day",
    f"""WITH {t.DRAFT_GROUPS_SQL.lstrip()}
SELECT draft_group_id, contest_start_date, game_count, contest_suffix, source_name
FROM draft_groups WHERE date_id = {DAY}""",
)
def doc1(spark, sf_dir):
    return reports.slates_on_day(t.draft_groups(spark, sf_dir), DAY)


@query(
    "doc2_slate_structure",
    f"""WITH {t.DRAFT_GROUPS_SQL.lstrip()}
SELECT source_id, display_name, avg(game_count) AS avg_games, count(*) AS slate_count
FROM draft_groups WHERE date_id BETWEEN {FIRST} AND {LAST} GROUP BY source_id, display_name""",
)
def doc2(spark, sf_dir):
    return reports.slate_structure(t.draft_groups(spark, sf_dir), FIRST, LAST)


@query(
    "doc3_value_plays",
    f"""WITH {t.PLAYER_BASE_SQL.lstrip()}
SELECT player_id, full_name, salary, actual_points, actual_points / (salary / 1000.0::DOUBLE) AS value
FROM player_base WHERE actual_points > 0 ORDER BY value DESC, player_id LIMIT 20""",
)
def doc3(spark, sf_dir):
    return reports.value_plays(t.player_base(spark, sf_dir))


@query(
    "doc4_points_by_ownership",
    f"""WITH {t.PLAYER_BASE_SQL.lstrip()}
SELECT CASE WHEN ownership < 10 THEN 'Low' WHEN ownership < 25 THEN 'Medium' ELSE 'High' END AS ownership_tier,
       avg(actual_points) AS avg_points, count(*) AS player_count FROM player_base GROUP BY 1""",
)
def doc4(spark, sf_dir):
    return reports.points_by_ownership(t.player_base(spark, sf_dir))


@query(
    "doc5_best_users",
    f"""WITH {t.USERS_SQL.lstrip()}
SELECT user_id, total_rosters, lineups_cashing,
       {marts.R2.format('100.0::DOUBLE * lineups_cashing / total_rosters')} AS cash_rate, roi
FROM users WHERE total_rosters >= 10 ORDER BY roi DESC, user_id, contest_id LIMIT 50""",
)
def doc5(spark, sf_dir):
    return reports.best_users(t.users(spark, sf_dir))


@query(
    "doc6_return_by_diversity",
    f"""WITH {t.USERS_SQL.lstrip()}
SELECT CASE WHEN unique_rosters = total_rosters THEN 'Full Diversity'
            WHEN unique_rosters / total_rosters > 0.8::DOUBLE THEN 'High Diversity'
            WHEN unique_rosters / total_rosters > 0.5::DOUBLE THEN 'Medium Diversity'
            ELSE 'Low Diversity' END AS strategy, avg(roi) AS avg_roi, count(*) AS user_count
FROM users WHERE total_rosters >= 20 GROUP BY 1""",
)
def doc6(spark, sf_dir):
    return reports.return_by_diversity(t.users(spark, sf_dir))


@query(
    "doc7_most_repeated",
    f"""WITH {t.ORDERS_SQL},{t.USER_LINEUPS_SQL}
SELECT user_id, lineup_hash, lineup_ct FROM user_lineups WHERE lineup_ct > 1
ORDER BY lineup_ct DESC, user_id, lineup_hash LIMIT 100""",
)
def doc7(spark, sf_dir):
    return reports.most_repeated(t.user_lineups(spark, sf_dir))


_RESULTS_SQL = f"""{t.lineups_sql(t.SHORT_SLOTS)},{t.USER_LINEUPS_SQL},{t.CONTEST_USERS_SQL},
results AS (
  SELECT u.user_id, u.roi, l.lineup_hash, l.points, l.is_cashing FROM contest_users u
  JOIN user_lineups e ON e.user_id = u.user_id AND e.contest_id = u.contest_id
  JOIN lineups l ON l.lineup_hash = e.lineup_hash AND l.contest_id = e.contest_id)"""


def _results(spark, sf_dir):
    return (
        t.contest_users(spark, sf_dir),
        t.user_lineups(spark, sf_dir),
        t.lineups(spark, sf_dir, t.SHORT_SLOTS),
    )


@query("doc8_results_above", f"WITH {_RESULTS_SQL} SELECT * FROM results WHERE roi > 0")
def doc8(spark, sf_dir):
    return reports.results_above(*_results(spark, sf_dir), roi=0)


@query(
    "doc13_results_with_totals",
    f"WITH {_RESULTS_SQL} SELECT *, count(*) OVER (PARTITION BY user_id) AS user_total_lineups FROM results",
)
def doc13(spark, sf_dir):
    return reports.results_with_totals(*_results(spark, sf_dir))


@query(
    "doc9_contrarian_lineups",
    f"""WITH {t.lineups_sql(t.SHORT_SLOTS)}
SELECT lineup_hash, points, avg_own, lineup_rank, payout FROM lineups WHERE is_cashing AND avg_own < 15
ORDER BY lineup_percentile DESC, lineup_hash LIMIT 50""",
)
def doc9(spark, sf_dir):
    return reports.contrarian_lineups(t.lineups(spark, sf_dir, t.SHORT_SLOTS))


@query(
    "doc10_results_by_stack_size",
    f"""WITH {t.lineups_sql(t.SHORT_SLOTS)}
SELECT correlated_players AS stack_size, avg(points) AS avg_points,
       sum(CASE WHEN is_cashing THEN 1 ELSE 0 END)::DOUBLE / count(*) AS cash_rate, count(*) AS lineup_count
FROM lineups GROUP BY correlated_players""",
)
def doc10(spark, sf_dir):
    return reports.results_by_stack_size(t.lineups(spark, sf_dir, t.SHORT_SLOTS))


@query(
    "doc11_rebuilt_lineups",
    f"""WITH {t.lineups_sql(t.SHORT_SLOTS)},{t.PLAYER_BASE_SQL}
SELECT l.lineup_hash, l.points, l.total_salary, a.full_name AS qb_name, a.actual_points AS qb_points,
       b.full_name AS rb1_name, b.actual_points AS rb1_points, c.full_name AS wr1_name, c.actual_points AS wr1_points
FROM lineups l JOIN player_base a ON l.pos_qb1 = a.player_id JOIN player_base b ON l.pos_rb1 = b.player_id
JOIN player_base c ON l.pos_wr1 = c.player_id
WHERE l.is_cashing ORDER BY l.points DESC, l.contest_id, l.lineup_hash LIMIT 10""",
)
def doc11(spark, sf_dir):
    slots = {"qb": "qb1", "rb1": "rb1", "wr1": "wr1"}
    return reports.rebuilt_lineups(t.lineups(spark, sf_dir, t.SHORT_SLOTS), t.player_base(spark, sf_dir), slots)


@query(
    "doc12_results_by_ownership",
    f"""WITH {t.lineups_sql(t.SHORT_SLOTS)}
SELECT CASE WHEN avg_own < 10 THEN 'Low Owned' WHEN avg_own < 20 THEN 'Medium Owned' ELSE 'High Owned' END AS ownership_tier,
       avg(points) AS avg_points, {R6.format('avg(lineup_percentile)')} AS avg_percentile,
       sum(CASE WHEN is_cashing THEN 1 ELSE 0 END)::DOUBLE / count(*) AS cash_rate
FROM lineups GROUP BY 1""",
)
def doc12(spark, sf_dir):
    found = reports.results_by_ownership(t.lineups(spark, sf_dir, t.SHORT_SLOTS))
    return found.withColumn("avg_percentile", round_to(F.col("avg_percentile"), 6))


@query(
    "doc14_player_results",
    f"""WITH {t.lineups_sql(SINGLE_GAME_SLOTS)},{t.PLAYER_BASE_SQL},
rostered AS (
  SELECT DISTINCT contest_id, lineup_hash, points, is_cashing, player_id FROM (
    UNPIVOT lineups ON {', '.join(f'pos_{s}' for s in SINGLE_GAME_SLOTS)} INTO NAME slot VALUE player_id))
SELECT full_name, salary, ownership, p.actual_points, count(*) AS times_rostered, avg(points) AS avg_lineup_points,
       sum(CASE WHEN is_cashing THEN 1 ELSE 0 END)::DOUBLE / count(*) AS cash_rate
FROM player_base p JOIN rostered r ON r.player_id = p.player_id
GROUP BY p.player_id, full_name, salary, ownership, p.actual_points""",
)
def doc14(spark, sf_dir):
    lineups = t.lineups(spark, sf_dir, SINGLE_GAME_SLOTS)
    return reports.player_results(t.player_base(spark, sf_dir), lineups, SINGLE_GAME_SLOTS)


_RETURNS_SQL = f"""{marts.TOP_USERS_SQL},
returns AS (SELECT slate_type, user_id, sum(roi) AS roi_sum FROM top_users GROUP BY slate_type, user_id)"""


@query(
    "doc15_ranked_users",
    f"""WITH {_RETURNS_SQL} SELECT *, rank() OVER (PARTITION BY slate_type ORDER BY roi_sum DESC) AS user_rank
FROM returns WHERE roi_sum > 0""",
)
def doc15(spark, sf_dir):
    return reports.ranked_users(marts.users_mart(spark, sf_dir))


@query("doc16_returns_per_user", f"WITH {_RETURNS_SQL} SELECT * FROM returns")
def doc16_returns(spark, sf_dir):
    return reports.returns_per_user(marts.users_mart(spark, sf_dir))


@query(
    "doc16_users_per_slate",
    f"WITH {_RETURNS_SQL} SELECT slate_type, count(DISTINCT user_id) AS users FROM top_users GROUP BY slate_type",
)
def doc16_users(spark, sf_dir):
    return reports.users_per_slate(marts.users_mart(spark, sf_dir))


@query(
    "doc16_correlation_grid",
    f"""WITH {marts.PAIR_SQL} SELECT position_1, position_2, {R6.format('avg(correlation)')} AS avg_correlation
FROM pair_corr WHERE team_relationship = 'same_team' GROUP BY position_1, position_2""",
)
def doc16_grid(spark, sf_dir):
    found = reports.correlation_grid(marts.pair_corr(spark, sf_dir))
    return found.withColumn("avg_correlation", round_to(F.col("avg_correlation"), 6))


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "rsh5_wide_grid",
    f"""WITH {marts.PAIR_SQL} SELECT position_1,
       {', '.join(f"avg(correlation) FILTER (position_2 = '{p}') AS {p}" for p in _TYPES)}
FROM pair_corr WHERE team_relationship = 'same_team' GROUP BY position_1""",
)
def rsh5(spark, sf_dir):
    return reports.wide_grid(marts.pair_corr(spark, sf_dir), _TYPES)


# --- data checks ------------------------------------------------------------------------------

_PROFILED = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")


def _profile_sql(c: str, kind: str) -> str:
    mean = R4.format(f"avg({c})") if c in _NUMBERS else "CAST(NULL AS DOUBLE)"
    spread = R4.format(f"stddev_samp({c})") if c in _NUMBERS else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{c}' AS column_name, '{kind}' AS column_type, CAST(min({c}) AS VARCHAR) AS smallest,
       CAST(max({c}) AS VARCHAR) AS largest, count(*) AS row_count, {mean} AS mean, {spread} AS deviation,
       100.0::DOUBLE * count_if({c} IS NULL) / count(*) AS null_pct FROM orders"""


@query("dq1_profile", "\nUNION ALL ".join(_profile_sql(c, k) for c, k in _PROFILED.items()))
def dq1(spark, sf_dir):
    return quality.profile(t.table(spark, sf_dir, "orders"))


_SKETCHED = {"l_orderkey": True, "l_partkey": True, "l_quantity": True, "l_extendedprice": True, "l_shipdate": False, "l_returnflag": False}


@query(
    "dq1_profile_sketches",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(DISTINCT {c}) AS distinct_values, true AS distinct_ok, true AS merged_ok, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS quartiles_ok FROM lineitem"
        for c, number in _SKETCHED.items()
    ),
)
def dq1_sketches(spark, sf_dir):
    """Sketches stored by month and merged, held against exact values: all within the stated errors."""
    rows = t.table(spark, sf_dir, "lineitem").select(*_SKETCHED)
    path = shared_folder(spark, "sketches")
    monthly = rows.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    quality.sketches(monthly, ["month"]).write.parquet(path)
    found = {r["column_name"]: r for r in quality.estimates(quality.merged(spark.read.parquet(path))).collect()}  # a row per column
    whole = {r["column_name"]: r["approx_distinct"] for r in quality.profile_sketches(rows).collect()}
    cells = []
    for c, number in _SKETCHED.items():
        distinct = F.count_distinct(c)
        near = lambda a, b: F.abs(a - b) <= F.ceil(distinct * quality.DISTINCT_ERROR)  # noqa: B023, E731
        within = F.lit(True) if number else F.lit(None).cast("boolean")
        for label, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)) if number else ():
            value, n = F.lit(found[c][label]), F.count(c)
            within = within & (F.count_if(F.col(c) < value) <= n * (q + quality.RANK_ERROR)) & (F.count_if(F.col(c) <= value) >= n * (q - quality.RANK_ERROR))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(found[c]["row_count"]).cast("long").alias("row_count"),
                distinct.alias("distinct_values"),
                near(F.lit(found[c]["approx_distinct"]), distinct).alias("distinct_ok"),
                near(F.lit(found[c]["approx_distinct"]), F.lit(whole[c])).alias("merged_ok"),
                within.alias("quartiles_ok"),
            )
        )
    return rows.agg(*[cell.alias(f"_{i}") for i, cell in enumerate(cells)]).select(F.inline(F.array(*[f"_{i}" for i in range(len(cells))])))


@query(
    "dq2_describe",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{k}' AS column_type, true AS nullable, "
        f"count_if({c} IS NULL)::BIGINT AS missing, count({c}) AS present FROM orders"
        for i, (c, k) in enumerate(_PROFILED.items())
    ),
)
def dq2(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    return quality.describe(orders).join(quality.null_counts(orders, orders.columns), "column_name")


_CHECKED = ("slate_id", "contest_id", "min_points", "top_10_percentile_points")


@query(
    "dq3_nulls",
    f"WITH {marts.MIN_POINTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count_if({c} IS NULL)::BIGINT AS missing, count({c}) AS present FROM rows_"
        for c in _CHECKED
    ),
)
def dq3(spark, sf_dir):
    rows = min_points.contest_points(*marts.min_points_inputs(spark, sf_dir), marts.START, marts.END)
    return quality.null_counts(rows, _CHECKED)


@query(
    "dq4_monotonic",
    f"""WITH {marts._COARSE_SQL}, found AS (
  SELECT contest_id, max(CASE WHEN lineup_rank = ceil(w * 0.05) THEN points END) AS p5,
         max(CASE WHEN lineup_rank = ceil(w * 0.10) THEN -points END) AS p10,
         max(CASE WHEN lineup_rank = ceil(w * 0.15) THEN points END) AS p15
  FROM coarse JOIN worst USING (contest_id) GROUP BY contest_id)
SELECT * FROM found WHERE p5 IS NOT NULL AND p10 IS NOT NULL AND p15 IS NOT NULL AND NOT (p5 >= p10 AND p10 >= p15)""",
)
def dq4(spark, sf_dir):
    """Points in the middle turned negative, so that there is something to find."""
    coarse = F.ceil(F.col("lineup_rank") / F.lit(5000.0)).cast("int")
    lineups = t.lineups(spark, sf_dir, t.SHORT_SLOTS).withColumn("lineup_rank", coarse)
    found = min_points.points_at_exact_rank(lineups).toDF("contest_id", "p5", "p10", "p15")
    lowest = min_points.points_at_exact_rank(lineups.withColumn("points", -F.col("points")))
    lowest = lowest.select("contest_id", F.col("top_10_percentile_points").alias("p10"))
    return quality.not_descending(found.drop("p10").join(lowest, "contest_id"), ["p5", "p10", "p15"]).select(
        "contest_id", "p5", "p10", "p15"
    )


@query(
    "dq5_load_batches",
    """SELECT 'events' AS dataset, count(*) AS row_count, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_load,
       CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_load, count(DISTINCT CAST(ts AS DATE)) AS loads FROM events
UNION ALL
SELECT 'orders', count(*), CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR),
       CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR), count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders""",
)
def dq5(spark, sf_dir):
    days = {"events": "ts", "orders": "o_orderdate"}
    tables = {
        name: t.table(spark, sf_dir, name).select(F.col(c).cast("date").cast("string").alias("load_ts"))
        for name, c in days.items()
    }
    return quality.load_batches(tables)


@query(
    "dq6_reconcile",
    """SELECT coalesce(a, b) AS code, CASE WHEN b IS NULL THEN 'left' ELSE 'right' END AS only_in
FROM (SELECT DISTINCT o_custkey AS a FROM orders WHERE o_orderstatus = 'F') x
FULL JOIN (SELECT DISTINCT o_custkey AS b FROM orders WHERE o_orderstatus = 'O') y ON a = b
WHERE a IS NULL OR b IS NULL""",
)
def dq6(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").withColumn("code", F.col("o_custkey"))
    return symmetric_difference(
        orders.filter(F.col("o_orderstatus") == "F"), orders.filter(F.col("o_orderstatus") == "O"), "code"
    )


_COUNTED = ("customer", "orders", "lineitem", "events")


@query(
    "dq7_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED),
)
def dq7(spark, sf_dir):
    return quality.row_counts({n: t.table(spark, sf_dir, n) for n in _COUNTED})


@query(
    "dq8_truncated_ranks",
    f"""WITH {marts.MIN_POINTS_SQL} SELECT contest_id, max_lineup_rank,
       CAST(floor(max_lineup_rank * 0.05::DOUBLE) AS BIGINT) AS rank_5pct,
       CAST(floor(max_lineup_rank * 0.10::DOUBLE) AS BIGINT) AS rank_10pct,
       CAST(floor(max_lineup_rank * 0.15::DOUBLE) AS BIGINT) AS rank_15pct FROM rows_""",
)
def dq8(spark, sf_dir):
    rows = min_points.contest_points(*marts.min_points_inputs(spark, sf_dir), marts.START, marts.END)
    return min_points.truncated_ranks(rows.select("contest_id", "max_lineup_rank"))
