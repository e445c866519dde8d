"""Single operators and functions on derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import marts, tables as t
from checks.registry import query
from slatecraft.functions import casting, dates, metrics, stacks, text
from slatecraft.functions.numeric import correlation, ratio, round_to
from slatecraft.operators import keyed, ranking, reshape
from slatecraft.operators.shares import distribution
from slatecraft.plans import correlations, min_points, summaries, team_stacks
from slatecraft.plans.normalise import json_or_null
from slatecraft.plans.top_lineups import SINGLE_GAME_SLOTS

SLOT_COLUMNS = [f"pos_{s}" for s in SINGLE_GAME_SLOTS]


def single_game(spark, sf_dir):
    return t.lineups(spark, sf_dir, SINGLE_GAME_SLOTS)


SINGLE_SQL = t.lineups_sql(SINGLE_GAME_SLOTS)

# --- projection -------------------------------------------------------------------------------


@query(
    "prj1_renamed_columns",
    f"WITH {t.ORDERS_SQL},{t.LINEUP_CONTESTS_SQL} SELECT contest_id, contest_group_id AS draft_group_id, cash_line FROM contests",
)
def prj1(spark, sf_dir):
    """Projection with a rename, and two columns dropped."""
    contests = t.lineup_contests(spark, sf_dir).select(
        "contest_id", F.col("contest_group_id").alias("draft_group_id"), "cash_line", "entries", "date_id"
    )
    return contests.drop("entries", "date_id")


@query(
    "prj3_typed_json_fields",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing
FROM events""",
)
def prj3(spark, sf_dir):
    fields = F.from_json("props", "k string, none string")
    events = t.table(spark, sf_dir, "events").select("event_id", fields.alias("p"))
    return events.select("event_id", casting.int_from_text(F.col("p.k")).alias("k"), F.col("p.none").alias("missing"))


@query(
    "fn2_json_entries",
    "SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS INTEGER) AS value FROM events",
)
def fn2(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    entries = F.from_json("props", "map<string, int>")
    return reshape.explode_map(events, ["event_id"], entries, "key", "value")


@query("prj4_size_tiers", f"WITH {t.CONTESTS_SQL.lstrip()} SELECT contest_id, {t.TIER_SQL} AS size_category FROM contests")
def prj4(spark, sf_dir):
    return t.contests(spark, sf_dir).select("contest_id", text.size_tier(F.col("contest_size")).alias("size_category"))


@query(
    "prj5_recoded_positions",
    """SELECT p_partkey, CASE WHEN p IN ('LW', 'RW') THEN 'W' ELSE p END AS position
FROM (SELECT p_partkey, CASE p_type WHEN 'LARGE' THEN 'LW' WHEN 'SMALL' THEN 'RW' ELSE p_type END AS p FROM part)""",
)
def prj5(spark, sf_dir):
    wing = F.when(F.col("p_type") == "LARGE", "LW").when(F.col("p_type") == "SMALL", "RW").otherwise(F.col("p_type"))
    return t.table(spark, sf_dir, "part").select("p_partkey", text.merge_wings(wing).alias("position"))


@query(
    "prj7_team_codes",
    f"""SELECT team, coalesce(ours, team) AS mapped, count(*) AS n
FROM (SELECT {t._code_sql(t._BRAND_SQL, t.TEAM_CODES)} AS team FROM part)
LEFT JOIN (VALUES ('CBJ','CLB'), ('LAK','LA'), ('NSH','NAS'), ('SJS','SJ'), ('TBL','TB'), ('WSH','WAS')) m(theirs, ours)
  ON team = theirs GROUP BY team, ours""",
)
def prj7(spark, sf_dir):
    """Codes of a small fixed table, unknown ones as they are (a left join to the table)."""
    teams = t.table(spark, sf_dir, "part").select(t._code(t._brand_number(), t.TEAM_CODES).alias("team"))
    mapped = text.recode(F.col("team"), text.LINE_TEAM_CODES).alias("mapped")
    return teams.select("team", mapped).groupBy("team", "mapped").agg(F.count("*").alias("n"))


@query(
    "jn4_mapping_join",
    f"""SELECT team, coalesce(ours, team) AS mapped, count(*) AS n
FROM (SELECT {t._code_sql(t._BRAND_SQL, t.TEAM_CODES)} AS team FROM part)
LEFT JOIN (VALUES ('CBJ','CLB'), ('LAK','LA'), ('NSH','NAS'), ('SJS','SJ'), ('TBL','TB'), ('WSH','WAS')) m(theirs, ours)
  ON team = theirs GROUP BY team, ours""",
)
def jn4(spark, sf_dir):
    """The same as a join to literal rows; six rows, so broadcasting them is safe."""
    teams = t.table(spark, sf_dir, "part").select(t._code(t._brand_number(), t.TEAM_CODES).alias("team"))
    codes = spark.createDataFrame(list(text.LINE_TEAM_CODES.items()), "team string, ours string")
    return (
        teams.join(F.broadcast(codes), "team", "left")
        .groupBy("team", F.coalesce("ours", "team").alias("mapped"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "prj9_all_plus_more",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, len(string_split(p_name, ' ')) AS words,
       'f' || p_size AS line FROM part""",
)
def prj9(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select(
        "*",
        F.size(text.name_parts(F.col("p_name"), " ")).cast("long").alias("words"),
        F.concat(F.lit("f"), F.col("p_size").cast("string")).alias("line"),
    )


# --- filters ----------------------------------------------------------------------------------


@query(
    "flt1_comparison",
    f"WITH {SINGLE_SQL} SELECT contest_id, lineup_hash, lineup_rank FROM lineups WHERE lineup_percentile <= 0.01::DOUBLE AND is_cashing",
)
def flt1(spark, sf_dir):
    lineups = single_game(spark, sf_dir)
    return lineups.filter((F.col("lineup_percentile") <= 0.01) & F.col("is_cashing")).select(
        "contest_id", "lineup_hash", "lineup_rank"
    )


@query("flt2_in_list", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('LARGE', 'SMALL', 'PROMO')")
def flt2(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select("p_partkey", "p_type").filter(F.col("p_type").isin("LARGE", "SMALL", "PROMO"))


@query("flt3_any_of_array", "SELECT p_partkey, p_type FROM part WHERE p_type = ANY(['LARGE', 'SMALL'])")
def flt3(spark, sf_dir):
    wanted = F.array(F.lit("LARGE"), F.lit("SMALL"))
    return t.table(spark, sf_dir, "part").select("p_partkey", "p_type").filter(F.array_contains(wanted, F.col("p_type")))


@query(
    "flt5_complete_rows",
    f"WITH {SINGLE_SQL} SELECT lineup_hash FROM lineups WHERE {' AND '.join(f'{c} IS NOT NULL' for c in SLOT_COLUMNS)}",
)
def flt5(spark, sf_dir):
    return single_game(spark, sf_dir).dropna(how="any", subset=SLOT_COLUMNS).select("lineup_hash")


@query("flt7_date_range", f"WITH {t.ORDERS_SQL} SELECT contest_id, lineup_hash, date_id FROM lineup_heads WHERE date_id >= 19960101 AND date_id <= 19981231")
def flt7(spark, sf_dir):
    heads = t._orders(spark, sf_dir).select("contest_id", "lineup_hash", "date_id")
    return heads.filter(dates.within_ids(F.col("date_id"), "1996-01-01", "1998-12-31"))


@query("flt7_open_range", f"WITH {t.ORDERS_SQL} SELECT contest_id, lineup_hash, date_id FROM lineup_heads WHERE date_id >= 19990101")
def flt7_open(spark, sf_dir):
    heads = t._orders(spark, sf_dir).select("contest_id", "lineup_hash", "date_id")
    return heads.filter(dates.within_ids(F.col("date_id"), "1999-01-01", None))


@query(
    "flt9_between_columns",
    f"""WITH {SINGLE_SQL}, cuts AS (SELECT contest_id, CAST(ceil(max(lineup_rank) * 0.15) AS INTEGER) AS cut FROM lineups GROUP BY contest_id)
SELECT contest_id, lineup_hash FROM lineups JOIN cuts USING (contest_id) WHERE lineup_rank <= cut""",
)
def flt9(spark, sf_dir):
    lineups = single_game(spark, sf_dir).select("contest_id", "lineup_hash", "lineup_rank")
    cuts = min_points.rank_cutoffs(lineups)
    return lineups.join(cuts, "contest_id").filter(F.col("lineup_rank") <= F.col("rank_15_percentile")).select("contest_id", "lineup_hash")


@query(
    "flt11_name_pattern",
    """SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_partkey % 100 = s_suppkey
WHERE upper(p_name) LIKE '%' || upper(substr(s_name, 1, 1)) || '%'""",
)
def flt11(spark, sf_dir):
    part, supplier = t.table(spark, sf_dir, "part"), t.table(spark, sf_dir, "supplier")
    named = text.name_within(F.upper("p_name"), F.upper(F.substring("s_name", 1, 1)))
    return part.join(supplier, (F.col("p_partkey") % 100 == F.col("s_suppkey")) & named).select("p_partkey", "s_suppkey")


@query(
    "flt12_having",
    "SELECT l_partkey, count(*) AS n, avg(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey HAVING count(*) > 30",
)
def flt12(spark, sf_dir):
    items = t.table(spark, sf_dir, "lineitem")
    return items.groupBy("l_partkey").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("quantity")).filter(F.col("n") > 30)


@query("flt14_between", f"WITH {t.ORDERS_SQL} SELECT lineup_hash FROM lineup_heads WHERE date_id BETWEEN 19970101 AND 19991231")
def flt14(spark, sf_dir):
    return t._orders(spark, sf_dir).filter(F.col("date_id").between(19970101, 19991231)).select("lineup_hash")


@query(
    "flt15_combined_tests",
    f"""WITH {t.CONTESTS_SQL.lstrip()} SELECT contest_id FROM contests
WHERE {t.TIER_SQL} = ANY(['4_Large', '5_Massive']) AND slate_type = 'BUILDING' AND multi_entry_max >= 100""",
)
def flt15(spark, sf_dir):
    large = text.size_tier(F.col("contest_size")).isin("4_Large", "5_Massive")
    return (
        t.contests(spark, sf_dir)
        .filter(large & (F.col("slate_type") == "BUILDING") & (F.col("multi_entry_max") >= 100))
        .select("contest_id")
    )


# --- joins ------------------------------------------------------------------------------------


@query(
    "jn1_one_key",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def jn1(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return orders.join(t.table(spark, sf_dir, "customer"), "c_custkey").select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "jn2_two_keys",
    f"""WITH {SINGLE_SQL},{t.players_sql()}
SELECT l.lineup_hash, p.full_name, p.salary FROM lineups l JOIN players p ON p.player_id = l.pos_cpt1 AND p.date_id = l.date_id""",
)
def jn2(spark, sf_dir):
    captains = single_game(spark, sf_dir).select("lineup_hash", "date_id", F.col("pos_cpt1").alias("player_id"))
    return captains.join(t.players(spark, sf_dir).hint("merge"), ["player_id", "date_id"]).select("lineup_hash", "full_name", "salary")


@query(
    "jn3_role_join",
    f"""WITH {SINGLE_SQL},{t.players_sql(True)}, cells AS (
  SELECT lineup_hash, date_id, unnest({list(SINGLE_GAME_SLOTS)}) AS pos_slot, unnest([{', '.join(SLOT_COLUMNS)}]) AS player_id FROM lineups)
SELECT c.lineup_hash, c.pos_slot, p.roster_position, p.salary FROM cells c JOIN players p
  ON p.player_id = c.player_id AND p.date_id = c.date_id
 AND ((c.pos_slot = 'cpt1' AND p.roster_position = 'CPT') OR (c.pos_slot <> 'cpt1' AND p.roster_position <> 'CPT'))""",
)
def jn3(spark, sf_dir):
    roles = {"cpt1": "CPT"}
    cells = reshape.unpivot_slots(single_game(spark, sf_dir), ["lineup_hash", "date_id"], SINGLE_GAME_SLOTS)
    cells = cells.withColumn("role", keyed.slot_role(F.col("pos_slot"), roles))
    players = t.players(spark, sf_dir, True).withColumn("role", keyed.player_role(F.col("roster_position"), roles))
    return cells.join(players.hint("merge"), ["player_id", "date_id", "role"]).select("lineup_hash", "pos_slot", "roster_position", "salary")


@query(
    "jn5_name_join",
    f"""WITH {t.PLAYED_SQL},{t.LINES_SQL},
codes(theirs, ours) AS (VALUES ('CBJ','CLB'), ('LAK','LA'), ('NSH','NAS'), ('SJS','SJ'), ('TBL','TB'), ('WSH','WAS')),
listed AS (SELECT game_date, coalesce(ours, team) AS team, trim(upper(last_name)) AS name, line FROM lines LEFT JOIN codes ON team = theirs)
SELECT p.player_id, p.event_id, p.event_team_id, l.line FROM performances p LEFT JOIN listed l
  ON p.current_team = l.team AND p.game_date = l.game_date
 AND (trim(upper(p.last_name)) = l.name OR upper(p.full_name) LIKE '%' || l.name || '%')""",
)
def jn5(spark, sf_dir):
    extra = ("full_name", "last_name", "current_team", "game_date")
    played = correlations.performances(t.played(spark, sf_dir), extra).withColumns(
        {"clean_last_name": text.clean_name(F.col("last_name")), "game_date": F.to_date("game_date")}
    )
    lined = correlations.with_lines(played, t.lines(spark, sf_dir))
    return lined.select("player_id", "event_id", "event_team_id", "line")


@query(
    "jn8_left_joins",
    f"""WITH {marts.MIN_POINTS_BASE_SQL}
SELECT c.contest_id, min_points, max_points, top_5_percentile_points FROM contests c
LEFT JOIN measured m ON m.contest_id = c.contest_id""",
)
def jn8(spark, sf_dir):
    contests, lineups, _ = marts.min_points_inputs(spark, sf_dir)
    return (
        contests.select("contest_id")
        .join(min_points.cashing_points(lineups), "contest_id", "left")
        .join(min_points.points_at_cutoffs(lineups), "contest_id", "left")
        .select("contest_id", "min_points", "max_points", "top_5_percentile_points")
    )


@query(
    "jn9_distinct_after_fan_out",
    """SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
)
def jn9(spark, sf_dir):
    """The repeating side is made distinct before the join, the result once more after it."""
    items = t.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    pairs = items.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").distinct()
    return t.table(spark, sf_dir, "orders").join(pairs, "o_orderkey").select("o_custkey", "l_suppkey").distinct()


@query(
    "jn10_semi_prefilter",
    f"""WITH {SINGLE_SQL},{t.players_sql()} SELECT player_id, date_id, salary FROM players
WHERE (player_id, date_id) IN (SELECT (pos_cpt1, date_id) FROM lineups WHERE is_cashing AND pos_cpt1 IS NOT NULL)""",
)
def jn10(spark, sf_dir):
    needed = single_game(spark, sf_dir).filter(F.col("is_cashing")).select(F.col("pos_cpt1").alias("player_id"), "date_id")
    return keyed.semi_prefilter(t.players(spark, sf_dir), needed, ["player_id", "date_id"]).select("player_id", "date_id", "salary")


@query(
    "jn12_left_join_top1",
    """SELECT c_custkey, o_orderkey AS best_order, o_totalprice AS best_price FROM customer LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1)
ON o_custkey = c_custkey""",
)
def jn12(spark, sf_dir):
    best = F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_totalprice", -F.col("o_orderkey")))
    top = t.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(best.alias("b"))
    return t.table(spark, sf_dir, "customer").join(top, "c_custkey", "left").select(
        "c_custkey", F.col("b.o_orderkey").alias("best_order"), F.col("b.o_totalprice").alias("best_price")
    )


@query(
    "jn13_constant_condition",
    """SELECT c_mktsegment, count(*) AS n,
  (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, c_nationkey LIMIT 1) AS top_nation
FROM customer GROUP BY c_mktsegment""",
)
def jn13(spark, sf_dir):
    """One chosen row next to every row of a report, as a scalar subquery."""
    customer = t.table(spark, sf_dir, "customer")
    counted = customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    top = counted.agg(F.min_by("c_nationkey", F.struct(-F.col("n"), "c_nationkey")).alias("top")).scalar()
    return customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")).withColumn("top_nation", top)


# --- aggregates -------------------------------------------------------------------------------


@query(
    "agg4_distinct_pairs",
    "SELECT l_returnflag, count(DISTINCT l_partkey || '_' || l_suppkey) AS pairs FROM lineitem GROUP BY l_returnflag",
)
def agg4(spark, sf_dir):
    return t.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey", "l_suppkey").alias("pairs"))


@query(
    "agg6_arg_max",
    f"""WITH {SINGLE_SQL} SELECT contest_id, arg_max(payout, (lineup_rank, -payout)) FILTER (payout IS NOT NULL AND lineup_rank <= 80000) AS last_payout
FROM lineups GROUP BY contest_id""",
)
def agg6(spark, sf_dir):
    usable = F.col("payout").isNotNull() & (F.col("lineup_rank") <= 80000)
    key = F.when(usable, F.struct("lineup_rank", -F.col("payout")))
    return single_game(spark, sf_dir).groupBy("contest_id").agg(F.max_by("payout", key).alias("last_payout"))


@query(
    "agg7_correlation",
    f"""SELECT l_returnflag, l_linenumber, {marts.R6.format('corr(l_quantity, floor(l_extendedprice))')} AS r,
       CASE WHEN isnan(corr(l_quantity, l_linenumber)) THEN NULL ELSE corr(l_quantity, l_linenumber) END AS flat
FROM lineitem GROUP BY l_returnflag, l_linenumber""",
)
def agg7(spark, sf_dir):
    items = t.table(spark, sf_dir, "lineitem")
    return items.groupBy("l_returnflag", "l_linenumber").agg(
        round_to(correlation(F.col("l_quantity"), t.whole("l_extendedprice")), 6).alias("r"),
        correlation(F.col("l_quantity"), F.col("l_linenumber").cast("double")).alias("flat"),
    )


@query(
    "agg8_deviation",
    f"SELECT l_partkey, {marts.R6.format('stddev(l_quantity)')} AS deviation FROM lineitem GROUP BY l_partkey",
)
def agg8(spark, sf_dir):
    return t.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(round_to(F.stddev_samp("l_quantity"), 6).alias("deviation"))


_LISTS_SQL = f"""{marts.STACKS_SQL},
lists AS (
  SELECT contest_id, lineup_rank, list(stack_size ORDER BY stack_size DESC) AS sizes,
         string_agg(DISTINCT position_combo, ' ' ORDER BY position_combo) AS combos
  FROM team_counts GROUP BY contest_id, lineup_rank)"""


def _lists(spark, sf_dir):
    """Stack sizes and position texts of each line-up, made inside its row."""
    found = stacks.stacks(stacks.slot_entries(t.STACK_SLOTS))
    combos = F.array_sort(F.array_distinct(F.transform(F.col("s"), lambda x: x["position_combo"])))
    return (
        marts.mart(spark, sf_dir, marts.STACKED)
        .select("contest_id", "lineup_rank", found.alias("s"))
        .filter(F.size("s") > 0)
        .select("contest_id", "lineup_rank", stacks.sizes_descending(F.col("s")).alias("sizes"), combos.alias("combos"))
    )


@query(
    "agg11_ordered_lists",
    f"WITH {_LISTS_SQL} SELECT contest_id, lineup_rank, array_to_string(sizes, ',') AS sizes, combos FROM lists",
)
def agg11(spark, sf_dir):
    return _lists(spark, sf_dir).select(
        "contest_id", "lineup_rank", stacks.joined(F.col("sizes")).alias("sizes"), F.array_join("combos", " ").alias("combos")
    )


@query(
    "agg18_distinct_months",
    "SELECT o_custkey, count(DISTINCT date_trunc('month', o_orderdate)) AS months FROM orders GROUP BY o_custkey",
)
def agg18(spark, sf_dir):
    month = F.date_trunc("month", F.col("o_orderdate"))
    return t.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_distinct(month).alias("months"))


@query(
    "agg19_two_levels",
    f"""WITH per_part AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL),
totals AS (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY ALL)
SELECT l_suppkey, {marts.R6.format('max(n / total)')} AS largest_share, {marts.R6.format('sum(n) / max(total)')} AS all_shares
FROM per_part JOIN totals USING (l_suppkey) GROUP BY l_suppkey""",
)
def agg19(spark, sf_dir):
    """Counts per key and sub-key, then their largest share; the total comes from the same counts."""
    counts = t.table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    return counts.groupBy("l_suppkey").agg(
        round_to(ratio(F.max("n"), F.sum("n")), 6).alias("largest_share"),
        round_to(ratio(F.sum("n"), F.sum("n")), 6).alias("all_shares"),
    )


@query("agg20_distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def agg20(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()


@query(
    "agg21_first_after_sort",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END DESC NULLS LAST, o_orderkey) = 1""",
)
def agg21(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return keyed.top1_per_key(orders, ["o_custkey"], [*keyed.descending(price), F.col("o_orderkey")]).drop("o_orderstatus")


@query(
    "agg22_distinct_on",
    """SELECT DISTINCT ON (l_partkey, l_returnflag) l_partkey, l_returnflag, l_orderkey, l_linenumber FROM lineitem
ORDER BY l_partkey, l_returnflag, l_orderkey, l_linenumber""",
)
def agg22(spark, sf_dir):
    items = t.table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber")
    return keyed.distinct_on(items, ["l_partkey", "l_returnflag"])


@query(
    "agg27_group_statistics",
    """SELECT c_mktsegment, count(*) AS employee_count, avg(floor(c_acctbal)) AS avg_age, min(floor(c_acctbal)) AS min_age,
       max(floor(c_acctbal)) AS max_age FROM customer GROUP BY c_mktsegment""",
)
def agg27(spark, sf_dir):
    people = t.table(spark, sf_dir, "customer").withColumn("age", t.whole("c_acctbal"))
    return summaries.group_statistics(people, "c_mktsegment", "age")


# --- windows, ranks, sorting --------------------------------------------------------------------


@query(
    "win1_top1_per_key",
    f"WITH {t.PLAYED_SQL} SELECT player_id, event_id, event_team_id, proj_points, actual_points, position FROM performances",
)
def win1(spark, sf_dir):
    return correlations.performances(t.played(spark, sf_dir))


@query(
    "win2_top1_of_counts",
    """SELECT l_returnflag, l_suppkey, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_suppkey
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_suppkey) = 1""",
)
def win2(spark, sf_dir):
    counts = t.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))
    return keyed.top1_per_key(counts, ["l_returnflag"], [-F.col("n"), F.col("l_suppkey")])


@query(
    "win3_top1_overall",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 1",
)
def win3(spark, sf_dir):
    counts = t.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "l_partkey").limit(1)


@query(
    "win4_share_of_all",
    f"""SELECT l_returnflag, count(*) AS n, {marts.R2.format('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()')} AS pct
FROM lineitem GROUP BY l_returnflag""",
)
def win4(spark, sf_dir):
    return distribution(t.table(spark, sf_dir, "lineitem"), F.col("l_returnflag"), "l_returnflag", "n", "pct")


@query(
    "win6_rows_per_key",
    "SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS orders_of_customer FROM orders",
)
def win6(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keyed.counts_joined(orders, ["o_custkey"], "orders_of_customer")


@query(
    "win7_rank_per_key",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS place FROM lineitem",
)
def win7(spark, sf_dir):
    items = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return ranking.add_rank(items, "l_quantity", ["l_returnflag"], "place")


@query(
    "srt4_top_rows",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25",
)
def srt4(spark, sf_dir):
    items = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return items.orderBy(F.desc_nulls_last("l_extendedprice"), "l_orderkey", "l_linenumber").limit(25)


# --- set operations, reshaping ------------------------------------------------------------------


@query(
    "set1_union_all",
    "SELECT c_nationkey AS nation, 'c' AS side FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier UNION ALL SELECT n_nationkey, 'n' FROM nation",
)
def set1(spark, sf_dir):
    sides = {"customer": "c_nationkey", "supplier": "s_nationkey", "nation": "n_nationkey"}
    parts = [t.table(spark, sf_dir, n).select(F.col(c).alias("nation"), F.lit(n[0]).alias("side")) for n, c in sides.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("set2_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def set2(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return customers.union(t.table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query(
    "src8_union_by_name",
    """SELECT o_orderkey AS key, o_totalprice AS price, NULL AS quantity FROM orders
UNION ALL BY NAME SELECT l_quantity AS quantity, l_orderkey AS key, CAST(NULL AS DOUBLE) AS price FROM lineitem""",
)
def src8_union(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    items = t.table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("key"))
    return orders.unionByName(items, allowMissingColumns=True)


@query(
    "rsh1_slots_to_rows",
    f"""WITH {SINGLE_SQL} SELECT contest_id, lineup_hash, unnest({list(SINGLE_GAME_SLOTS)}) AS pos_slot,
       unnest([{', '.join(SLOT_COLUMNS)}]) AS player_id FROM lineups""",
)
def rsh1(spark, sf_dir):
    return reshape.unpivot_slots(single_game(spark, sf_dir), ["contest_id", "lineup_hash"], SINGLE_GAME_SLOTS)


@query(
    "rsh2_attributes_to_rows",
    f"""WITH {marts.mart_sql(marts.STACKED)} SELECT contest_id, lineup_rank, total_own, total_salary,
       unnest({list(t.STACK_SLOTS)}) AS position_slot, unnest([{', '.join(f'pos_{s}_team' for s in t.STACK_SLOTS)}]) AS team,
       unnest([{', '.join(f'pos_{s}_real' for s in t.STACK_SLOTS)}]) AS position_raw FROM mart""",
)
def rsh2(spark, sf_dir):
    return team_stacks.positions_long(marts.mart(spark, sf_dir, marts.STACKED), t.STACK_SLOTS)


@query(
    "rsh3_unpivot_filled",
    f"""WITH {SINGLE_SQL} SELECT contest_id, lineup_hash, slot, player_id FROM (
  UNPIVOT (SELECT contest_id, lineup_hash, {', '.join(SLOT_COLUMNS)} FROM lineups) ON {', '.join(SLOT_COLUMNS)} INTO NAME slot VALUE player_id)""",
)
def rsh3(spark, sf_dir):
    return reshape.unpivot_filled(single_game(spark, sf_dir), ["contest_id", "lineup_hash"], SLOT_COLUMNS, "slot", "player_id")


@query(
    "rsh9_split_names",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
)
def rsh9(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select("p_partkey", F.explode(text.name_parts(F.col("p_name"), " ")).alias("word"))


@query(
    "rsh10_list_items",
    f"WITH {_LISTS_SQL} SELECT contest_id, lineup_rank, unnest(sizes) AS stack_size FROM lists",
)
def rsh10(spark, sf_dir):
    return _lists(spark, sf_dir).select("contest_id", "lineup_rank", F.explode("sizes").alias("stack_size"))


@query(
    "rsh11_list_prefixes",
    f"""WITH {_LISTS_SQL}
SELECT contest_id, lineup_rank, array_to_string(sizes[1:n], ',') AS prefix FROM (SELECT *, unnest(range(1, len(sizes))) AS n FROM lists)""",
)
def rsh11(spark, sf_dir):
    prefixes = F.explode(stacks.proper_prefixes(F.col("sizes"))).alias("p")
    return _lists(spark, sf_dir).select("contest_id", "lineup_rank", prefixes).select(
        "contest_id", "lineup_rank", stacks.joined(F.col("p")).alias("prefix")
    )


# --- scalar functions ---------------------------------------------------------------------------


@query(
    "fn3_json_or_null",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN '["' || o_orderstatus || '"]' END AS listed FROM orders""",
)
def fn3(spark, sf_dir):
    listed = F.filter(F.array("o_orderstatus"), lambda x: x != "P")
    return t.table(spark, sf_dir, "orders").select("o_orderkey", json_or_null(listed).alias("listed"))


@query(
    "fn4_casts",
    """SELECT o_orderkey, CAST(round(o_totalprice) AS INTEGER) AS from_text, CAST(round_even(o_totalprice / 2, 0) AS INTEGER) AS from_double,
       o_orderstatus = 'F' AS flag, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
)
def fn4(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        casting.int_from_text(F.col("o_totalprice").cast("string")).alias("from_text"),
        casting.int_from_double(F.col("o_totalprice") / 2).alias("from_double"),
        casting.bool_from_text((F.col("o_orderstatus") == "F").cast("string")).alias("flag"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )


@query(
    "fn5_path_parts",
    """SELECT p_partkey, list_extract(string_split('a/' || p_brand || '/' || p_type || '/data.parquet', '/'), -2) AS folder,
       split_part('a/' || p_brand || '/' || p_type || '/data.parquet', '/', -3) AS parent,
       replace(p_brand, '#', '') AS plain FROM part""",
)
def fn5(spark, sf_dir):
    path = F.concat(F.lit("a/"), "p_brand", F.lit("/"), "p_type", F.lit("/data.parquet"))
    return t.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.element_at(F.split(path, "/"), -2).alias("folder"),
        dates.path_part(path, -3).alias("parent"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit("")).alias("plain"),
    )


@query(
    "fn8_first_digit",
    """SELECT p_partkey, regexp_replace(p_brand || p_size, '[0-9]', '') AS stripped, trim(upper(' ' || p_name)) AS name,
       lower(p_type) AS kind FROM part""",
)
def fn8(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select(
        "p_partkey",
        text.strip_first_digit(F.concat("p_brand", F.col("p_size").cast("string"))).alias("stripped"),
        text.clean_name(F.concat(F.lit(" "), "p_name")).alias("name"),
        F.lower("p_type").alias("kind"),
    )


@query(
    "fn11_rounding",
    f"SELECT o_orderkey, {marts.R2.format('o_totalprice / 3')} AS two, {marts.R1.format('o_totalprice / 7')} AS one, CAST(ceil(o_totalprice * 0.05) AS BIGINT) AS up FROM orders",
)
def fn11(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        round_to(F.col("o_totalprice") / 3, 2).alias("two"),
        round_to(F.col("o_totalprice") / 7, 1).alias("one"),
        F.ceil(F.col("o_totalprice") * 0.05).alias("up"),
    )


@query(
    "fn15_list_functions",
    """SELECT o_orderkey, array_to_string(range(1, day(o_orderdate)), ',') AS numbers, len(range(1, day(o_orderdate)))::BIGINT AS n FROM orders""",
)
def fn15(spark, sf_dir):
    """``range(1, n)`` without its end, empty for n = 1."""
    numbers = F.filter(F.sequence(F.lit(0), F.dayofmonth("o_orderdate") - 1), lambda i: i >= 1)
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", stacks.joined(numbers).alias("numbers"), F.size(numbers).cast("long").alias("n")
    )


@query(
    "fn19_date_keys",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def fn19(spark, sf_dir):
    key = dates.date_id(F.col("o_orderdate"))
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", key.alias("date_id"), dates.day_from_id(key).cast("string").alias("day")
    )


@query(
    "fn20_months",
    """SELECT o_custkey, strftime(month, '%Y-%m-%d') AS month, strftime(month - INTERVAL 1 MONTH, '%Y-%m-%d') AS previous_first,
       strftime(last_day(month - INTERVAL 1 MONTH), '%Y-%m-%d') AS previous_last
FROM (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month
      FROM orders GROUP BY o_custkey)""",
)
def fn20(spark, sf_dir):
    spans = t.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")
    )
    months = spans.select("o_custkey", F.explode(dates.months_touched(F.col("a"), F.col("b"))).alias("month"))
    first, last = dates.previous_month(F.col("month"))
    return months.select("o_custkey", *[c.cast("string").alias(n) for n, c in (("month", F.col("month")), ("previous_first", first), ("previous_last", last))])


@query(
    "fn21_fixed_tables",
    """SELECT o_orderkey, CASE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) WHEN 3 THEN 'fd_classic' WHEN 4 THEN 'dk_classic' END AS slate_type,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS sport_id, CASE o_orderstatus WHEN 'F' THEN 'football/nfl' WHEN 'O' THEN 'basketball/nba' END AS league FROM orders""",
)
def fn21(spark, sf_dir):
    source = F.substring("o_orderpriority", 1, 1).cast("int")
    sport = F.when(F.col("o_orderstatus") == "F", "NFL").when(F.col("o_orderstatus") == "O", "NBA")
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.lookup(source, text.SLATE_TYPES).alias("slate_type"),
        text.lookup(sport, text.SPORT_IDS).alias("sport_id"),
        text.lookup(sport, text.ODDS_LEAGUES).alias("league"),
    )


@query(
    "fn22_derived_measures",
    f"""WITH {t.PLAYER_BASE_SQL.lstrip()} SELECT player_id, {marts.R6.format('actual_points / (salary / 1000.0::DOUBLE)')} AS value,
       actual_points - ownership AS error FROM player_base""",
)
def fn22(spark, sf_dir):
    return t.player_base(spark, sf_dir).select(
        "player_id",
        round_to(metrics.value_per_thousand(F.col("actual_points"), F.col("salary")), 6).alias("value"),
        metrics.projection_error(F.col("actual_points"), F.col("ownership")).alias("error"),
    )
