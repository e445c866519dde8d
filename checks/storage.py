"""Sources, sinks and the ledger; what is written lies in the shared folder and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import documents, marts, tables as t
from checks.registry import SQL, query
from slatecraft.plans import jobs, normalise, team_stacks
from slatecraft.session import shared_folder
from slatecraft.sources import layout, ledger, raw, schemas, sinks

_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


def orders(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("snk1_parquet", _ORDERS)
def snk1(spark, sf_dir):
    path = shared_folder(spark, "snk1")
    sinks.write_mart(orders(spark, sf_dir), path)
    return spark.read.parquet(path)


def _dated(spark, sf_dir):
    """Orders by sport (status), game type (priority) and date (month)."""
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.floor("o_totalprice").cast("double").alias("price"),
        F.col("o_orderstatus").alias("sport"),
        F.substring("o_orderpriority", 1, 1).alias("game_type"),
        F.date_format(F.date_trunc("year", "o_orderdate"), "yyyy-MM-dd").alias("date"),
    )


@query(
    "snk2_overwrite",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN -floor(o_totalprice) ELSE floor(o_totalprice) END AS price,
       o_orderstatus AS sport, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS game_type,
       strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS date FROM orders""",
)
def snk2(spark, sf_dir):
    """All dates, then one date once more with negative prices: only its partitions change."""
    path = shared_folder(spark, "snk2")
    rows = _dated(spark, sf_dir)
    sinks.replace_partitions(rows, path)
    again = rows.filter(F.col("date") == "1997-01-01").withColumn("price", -F.col("price"))
    sinks.replace_partitions(again, path)
    return layout.read_table(spark, *path.rsplit("/", 1)).withColumn("date", F.col("date").cast("string"))


@query(
    "snk3_landed_lines",
    "SELECT o_orderkey // 32 AS contest_id, 'u' || o_custkey AS user_id, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL".replace("// 32", f"// {documents.ENTRIES}"),
)
def snk3(spark, sf_dir):
    """Nested documents as gzip JSON lines with a load time, read with the declared schema."""
    path = shared_folder(spark, "snk3")
    sinks.write_landed(documents.raw_users(spark, sf_dir).drop("load_ts"), path)
    landed = raw.read_lines(spark, path, schemas.CONTEST_ANALYZE_RAW).filter(F.col("load_ts").isNotNull())
    return normalise.user_lineups(landed).groupBy("contest_id", "user_id").agg(F.count("*").alias("n"))


@query("snk4_nested_parquet", "SELECT c_custkey AS id, c_name AS name, count(*) AS orders, sum(floor(o_totalprice)) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def snk4(spark, sf_dir):
    path = shared_folder(spark, "snk4")
    sinks.write_nested(documents.nested_orders(spark, sf_dir), path)
    stored = spark.read.parquet(path).filter(F.col("load_ts").isNotNull())
    return stored.groupBy("customer.id", "customer.name").agg(F.count("*").alias("orders"), F.sum("total").alias("total"))


@query(
    "snk5_table",
    """SELECT o_custkey, c_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' GROUP BY ALL""",
)
def snk5(spark, sf_dir):
    """Two bucketed tables made from queries, one of them replaced as a whole, and a join on their key."""
    path = shared_folder(spark, "snk5")
    staged, people = "staged_" + path[-32:], "people_" + path[-32:]
    customers = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    sinks.replace_table(customers, people, f"{path}/people", "o_custkey", 8)
    rows = t.table(spark, sf_dir, "orders")
    for status in ("O", "F"):
        chosen = rows.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey")
        sinks.replace_table(chosen, staged, f"{path}/staged", "o_custkey", 8)
    return spark.table(staged).join(spark.table(people), "o_custkey").groupBy("o_custkey", "c_name").agg(F.count("*").alias("n"))


@query("snk6_lines_to_parquet", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def snk6(spark, sf_dir):
    path = shared_folder(spark, "snk6")
    rows = orders(spark, sf_dir)
    sinks.write_landed(rows, f"{path}/lines")
    sinks.write_mart(raw.read_lines(spark, f"{path}/lines", rows.schema), f"{path}/parquet")
    return spark.read.parquet(f"{path}/parquet")


_REPORTS = {
    "stack_sizes": ("mrt9_stack_sizes", ["stack_combination"]),
    "team_details": ("mrt10_team_details", ["team", "stack_size", "position_combo", "position_combo_count"]),
    "qb_patterns": ("mrt11_anchor_patterns", ["stack_type"]),
    "dst_patterns": ("mrt12_anchor_in_stack", ["dst_in_stack", "most_common_position_combo", "combo_count"]),
}


def _report_sql(output: str, name: str, label: list[str]) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in label)
    share = "pct_of_qb_stacks" if output == "qb_patterns" else "pct_of_lineups"
    return f"SELECT '{output}' AS output, concat_ws('|', {texts}) AS label, lineup_count, {share} AS share, avg_total_own, avg_lineup_rank FROM ({SQL[name]})"


@query("snk8_four_outputs", " UNION ALL ".join(_report_sql(output, *of) for output, of in _REPORTS.items()))
def snk8(spark, sf_dir):
    """The mart is written once, four reports are made from one reading of it, and read back in full."""
    path = shared_folder(spark, "snk8")
    sinks.write_mart(marts.mart(spark, sf_dir, marts.STACKED), f"{path}/mart")
    sinks.write_reports(team_stacks.all_reports(spark.read.parquet(f"{path}/mart"), t.STACK_SLOTS), path)
    rows = None
    for output, (_, label) in _REPORTS.items():
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in label]
        share = "pct_of_qb_stacks" if output == "qb_patterns" else "pct_of_lineups"
        found = spark.read.parquet(f"{path}/{output}").select(
            F.lit(output).alias("output"), F.concat_ws("|", *texts).alias("label"), "lineup_count",
            F.col(share).alias("share"), "avg_total_own", "avg_lineup_rank",
        )
        rows = found if rows is None else rows.unionByName(found)
    return rows


@query(
    "src4_document_files",
    "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
)
def src4(spark, sf_dir):
    """Files with one JSON array of records each."""
    path = shared_folder(spark, "src4")
    record = F.struct("s_suppkey", "s_name", "s_nationkey")
    chunks = t.table(spark, sf_dir, "supplier").groupBy(documents.chunk("s_suppkey").alias("k"))
    texts = chunks.agg(F.to_json(F.collect_list(record)).alias("value")).select("value")
    texts.write.option("maxRecordsPerFile", 1).text(path)
    schema = t.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey").schema
    return raw.read_documents(spark, path, schema)


@query(
    "src8_merge_schema",
    """SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority FROM orders""",
)
def src8(spark, sf_dir):
    """Files with different columns under one table."""
    path = shared_folder(spark, "src8")
    rows = t.table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "key", "o_totalprice": "price", "o_orderpriority": "priority"}
    )
    closed = F.col("o_orderstatus") == "F"
    rows.filter(closed).select("key", "price").write.parquet(f"{path}/a")
    rows.filter(~closed).select("priority", "key").write.parquet(f"{path}/b")
    return layout.read_merged(spark, [f"{path}/a", f"{path}/b"])


def _plain_layout(spark, sf_dir, root):
    """``<root>/NFL/orders/dk_classic/<year>-01-01``, one folder per year."""
    rows = t.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    for year in range(t.YEARS[0], t.YEARS[1] + 1):
        target = f"{root}/NFL/orders/dk_classic/{year}-01-01"
        rows.filter(F.col("y") == year).drop("y").write.parquet(target)


@query(
    "src9_path_columns",
    "SELECT o_orderkey, 'NFL' AS sport, 'dk_classic' AS game_type, year(o_orderdate) || '-01-01' AS date FROM orders",
)
def src9(spark, sf_dir):
    root = shared_folder(spark, "src9")
    _plain_layout(spark, sf_dir, root)
    return layout.with_path_columns(spark.read.parquet(f"{root}/NFL/orders/*/*"))


@query(
    "src11_month_folders",
    "SELECT o_orderkey, year(o_orderdate) || '-01-01' AS date FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
)
def src11(spark, sf_dir):
    """Only the folders of months in range that exist are read."""
    root = shared_folder(spark, "src11")
    _plain_layout(spark, sf_dir, root)
    wanted = [f"{root}/NFL/orders/*/{m}" for m in layout.month_patterns("1995-06-01", "1998-03-31")]
    found = spark.read.parquet(*layout.matching(spark, wanted))
    return layout.with_path_columns(found, typed=False)


@query(
    "src15_csv_files",
    "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def src15(spark, sf_dir):
    path = shared_folder(spark, "src15")
    for name, prefix, key in (("customer", "c", "c_custkey"), ("supplier", "s", "s_suppkey")):
        rows = t.table(spark, sf_dir, name).select(
            F.col(key).alias("key"), F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_acctbal").alias("balance")
        )
        rows.write.option("header", "true").csv(f"{path}/{name}")
    return raw.read_csv_files(spark, [f"{path}/customer", f"{path}/supplier"], rows.schema)


#: Events to a file of odds; a document has one at least.
_EVENTS_PER_FILE = 10_000


@query(
    "src16_odds_files",
    """SELECT user_id || '-' || event_type AS game_id, arg_min(value, (ts, event_id)) AS spread_open
FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type""",
)
def src16(spark, sf_dir):
    """Files of one array of indented documents each; a file for every document would take longer than reading them."""
    path = shared_folder(spark, "src16")
    made = documents.raw_odds(spark, sf_dir)
    pretty = made.select(F.to_json(F.struct(*made.columns), {"pretty": "true"}).alias("value"))
    files = max(1, t.table(spark, sf_dir, "events").count() // _EVENTS_PER_FILE)
    dealt = pretty.groupBy(F.pmod(F.xxhash64("value"), F.lit(files)).alias("file"))
    listed = dealt.agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value"))
    listed.select("value").write.option("maxRecordsPerFile", 1).text(path)
    odds = raw.read_documents(spark, path, schemas.ODDS_RAW)
    return normalise.pregame_odds(odds).select("game_id", "spread_open")


@query(
    "src1_damaged_lines",
    """SELECT year(o_orderdate) AS y, count(*) AS documents,
       count(*) FILTER (substr(o_orderpriority, 1, 1) IN ('1', '2', '3')) AS damaged,
       count(*) FILTER (substr(o_orderpriority, 1, 1) IN ('4', '5')) AS whole,
       count(*) FILTER (substr(o_orderpriority, 1, 1) = '1') AS cut_short,
       count(*) FILTER (substr(o_orderpriority, 1, 1) = '2') AS quoted
FROM orders GROUP BY 1""",
)
def src1(spark, sf_dir):
    """Lines cut short, with a number in quotes and with a fraction are told from whole ones, their text kept."""
    path = shared_folder(spark, "src1")
    kind = F.substring("o_orderpriority", 1, 1)
    line = F.to_json(F.struct("o_orderkey", "o_custkey"))
    damaged = (
        F.when(kind == "1", F.substring(line, F.lit(1), F.length(line) - 3))
        .when(kind == "2", F.regexp_replace(line, ":([0-9]+)}", ':"$1"}'))
        .when(kind == "3", F.regexp_replace(line, "}", ".5}"))
        .otherwise(line)
    )
    t.table(spark, sf_dir, "orders").select(damaged.alias("value"), F.year("o_orderdate").alias("y")).write.partitionBy("y").text(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType())])
    found = raw.read_lines(spark, path, schema, damaged=True)
    text = F.col(raw.DAMAGED)
    return found.groupBy("y").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count(text).alias("damaged"),
        F.count_if(text.isNull() & F.col("o_custkey").isNotNull()).alias("whole"),
        F.count_if(~text.endswith("}") & F.col("o_custkey").isNull()).alias("cut_short"),
        F.count_if(text.endswith('"}') & F.col("o_orderkey").isNotNull()).alias("quoted"),
    )


@query(
    "src12_non_empty",
    """SELECT 'orders' AS name, EXISTS (FROM orders) AS has_rows UNION ALL SELECT 'later', EXISTS (FROM orders WHERE o_orderdate > DATE '2500-01-01')""",
)
def src12(spark, sf_dir):
    rows = t.table(spark, sf_dir, "orders")
    tests = {"orders": rows, "later": rows.filter(F.col("o_orderdate") > F.lit("2500-01-01").cast("date"))}
    return spark.createDataFrame([(name, layout.has_rows(df)) for name, df in tests.items()], "name string, has_rows boolean")


# --- jobs -------------------------------------------------------------------------------------


def _land_contests(spark, sf_dir, root, broken=()):
    """A folder for each year, a document for some orders of one priority; urgent ones of some years are cut short."""
    keys = F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("contest_id")))
    made = (
        t.table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority", documents.chunk("o_orderkey").alias("k"))
        .agg(F.to_json(F.struct(keys.alias("live_contests"))).alias("value"))
    )
    cut = F.col("y").isin(*broken) & F.col("o_orderpriority").startswith("1")
    made = made.withColumn("value", F.when(cut, F.substring("value", F.lit(1), F.length("value") - 3)).otherwise(F.col("value")))
    stored = f"{root}/made"
    made.select("value", "y").write.parquet(stored)
    for year in range(t.YEARS[0], t.YEARS[1] + 1):
        day = spark.read.parquet(stored).filter(F.col("y") == year).select("value")
        day.write.text(f"{root}/landed/NFL/contests/dk_classic/{year}-01-01")


@query(
    "inc4_damaged_dates",
    """SELECT 'dds' AS pipeline, 'NFL' AS sport, 'contests' AS table_name, year(o_orderdate) || '-01-01' AS date,
       count(*) AS contests, year(o_orderdate) <> 1996 AS marked
FROM orders WHERE NOT (year(o_orderdate) = 1996 AND o_orderpriority LIKE '1%') AND year(o_orderdate) BETWEEN {} AND {}
GROUP BY ALL""".format(*t.YEARS),
)
def inc4(spark, sf_dir):
    """Dates are marked after their table is written, but not the one with damaged documents."""
    root = shared_folder(spark, "inc4")
    _land_contests(spark, sf_dir, root, broken=(1996,))
    jobs.normalise_pending(spark, f"{root}/landed", f"{root}/dds", f"{root}/ledger", "NFL", "contests", "2030-01-01")
    stored = layout.read_table(spark, f"{root}/dds", "contests").groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("contests"))
    done = ledger.read_ledger(spark, f"{root}/ledger").select("date", F.lit(True).alias("marked"))
    return stored.join(done, "date", "left").select(
        F.lit("dds").alias("pipeline"), F.lit("NFL").alias("sport"), F.lit("contests").alias("table_name"), "date", "contests",
        F.coalesce("marked", F.lit(False)).alias("marked"),
    )


@query(
    "inc7_back_fill",
    "SELECT year(o_orderdate) || '-01-01' AS date, CASE WHEN year(o_orderdate) <= 1997 THEN 1 ELSE 2 END AS run, count(*) AS contests FROM orders WHERE year(o_orderdate) BETWEEN {} AND {} GROUP BY ALL".format(*t.YEARS),
)
def inc7(spark, sf_dir):
    """A first run takes all dates landed and settled so far, a second one only those since."""
    root = shared_folder(spark, "inc7")
    _land_contests(spark, sf_dir, root)
    runs = []
    for number, day in enumerate(("1997-01-06", "2030-01-01"), 1):
        found = jobs.normalise_pending(spark, f"{root}/landed", f"{root}/dds", f"{root}/ledger", "NFL", "contests", day)
        runs += [(d, number) for d in found]
    stored = layout.read_table(spark, f"{root}/dds", "contests").groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("contests"))
    return stored.join(spark.createDataFrame(runs, "date string, run int"), "date").select("date", "run", "contests")


def _store_min_points_tables(spark, sf_dir, root):
    """The three tables of the job in date folders, with the declared columns."""
    contests, lineups, groups = marts.min_points_inputs(spark, sf_dir)
    day = lambda c: F.regexp_replace(F.col(c).cast("string"), "^(....)(..)(..)$", "$1-$2-$3")
    dated = contests.withColumn("date", day("date_id"))
    made = {
        "contests": dated,
        "lineups": lineups.drop("date_id").join(dated.select("contest_id", "date"), "contest_id"),
        "draft_groups": groups.withColumn("date", day("date_id")),
    }
    for name, df in made.items():
        schema = jobs.TABLES[name].stored_schema(spark)
        rows = df.withColumns({"sport": F.lit("NFL"), "game_type": F.lit("dk_classic")})
        cells = [F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType) for f in schema]
        sinks.replace_partitions(rows.select(*[c.alias(f.name) for c, f in zip(cells, schema)]), f"{root}/{name}")


def _stored_min_points(spark, sf_dir, start, end):
    root = shared_folder(spark, "min-points")
    _store_min_points_tables(spark, sf_dir, root)
    return jobs.min_points_between(spark, root, "NFL", start, end)


@query("flt8_pruned_min_points", f"WITH {marts.MIN_POINTS_SQL} SELECT * FROM min_points")
def flt8(spark, sf_dir):
    """Min points through the job's reader: only the folders of the months in range, of all three tables."""
    return _stored_min_points(spark, sf_dir, marts.START, marts.END)


@query("inc8_all_time", f"WITH {marts.MIN_POINTS_SQL.replace('WHERE date_id BETWEEN 19960101 AND 20001231', '')} SELECT * FROM min_points")
def inc8(spark, sf_dir):
    """The same job without dates: everything."""
    return _stored_min_points(spark, sf_dir, None, None)


# --- ledger -----------------------------------------------------------------------------------


def _days(spark, sf_dir, name, column):
    day = F.col(column).cast("date").cast("string")
    return t.table(spark, sf_dir, name).select(
        F.lit("dds").alias("pipeline"), F.lit("NFL").alias("sport"), F.lit("lineups").alias("table_name"), day.alias("date")
    ).distinct()


_CANDIDATES = "candidates AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders)"
_DONE = "done AS (SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem WHERE l_linenumber = 7 AND l_quantity > 20)"


def _done(spark, sf_dir):
    late = t.table(spark, sf_dir, "lineitem").filter((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 20))
    day = F.col("l_shipdate").cast("date").cast("string")
    return late.select(
        F.lit("dds").alias("pipeline"), F.lit("NFL").alias("sport"), F.lit("lineups").alias("table_name"), day.alias("date")
    )


def _ledger(spark, sf_dir):
    """A ledger table in which all finished dates were marked, twice."""
    path = shared_folder(spark, "ledger")
    ledger.mark(spark, path, _done(spark, sf_dir))
    ledger.mark(spark, path, _done(spark, sf_dir))
    return ledger.read_ledger(spark, path)


@query("inc1_ledger", f"WITH {_DONE} SELECT 'dds' AS pipeline, 'NFL' AS sport, 'lineups' AS table_name, date FROM done")
def inc1(spark, sf_dir):
    return _ledger(spark, sf_dir)


@query("inc2_pending_dates", f"WITH {_CANDIDATES}, {_DONE} SELECT date FROM candidates WHERE date NOT IN (SELECT date FROM done)")
def inc2(spark, sf_dir):
    return ledger.pending(_days(spark, sf_dir, "orders", "o_orderdate"), _ledger(spark, sf_dir)).select("date")


@query("inc5_settled", f"WITH {_CANDIDATES} SELECT date FROM candidates WHERE CAST(date AS DATE) <= DATE '1999-06-20' - 5")
def inc5(spark, sf_dir):
    days = _days(spark, sf_dir, "orders", "o_orderdate")
    return ledger.settled(days, F.lit("1999-06-20").cast("date"), 5).select("date")


@query(
    "inc6_refresh_today",
    f"""WITH {_CANDIDATES}, {_DONE}, today AS (SELECT max(date) AS d FROM done JOIN candidates USING (date))
SELECT date FROM candidates WHERE date NOT IN (SELECT date FROM done) OR date = (SELECT d FROM today)""",
)
def inc6(spark, sf_dir):
    """Today is the last finished date here, so it is wanted although it is in the ledger."""
    days, done = _days(spark, sf_dir, "orders", "o_orderdate"), _ledger(spark, sf_dir)
    today = done.join(days, "date", "left_semi").agg(F.max("date").alias("d")).scalar().cast("date")
    return ledger.pending_or_today(days, done, today).select("date")
