"""The URL filter against a plain loop over the rules."""

import random

from pyspark.sql import functions as F

from slatecraft.llm import queries, urls


def expected(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        path = rest[:cut]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[3] if best else None, best[4] if best else "allow")


def judged(spark, texts, rules):
    rows = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(texts)], "id long, url string, Host_ string")
    found = urls.judge(rows, urls.rules_frame(spark, rules)).collect()
    assert all(r["Host_"] == "kept" for r in found)
    return {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


def test_random_urls_and_rules(spark):
    rng = random.Random(5)
    host = lambda: ".".join(rng.choice(["a", "bb", "com", "é", ""]) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join("/" + rng.choice(["", "x", "xy", "ü%20"]) for _ in range(rng.randint(0, 3)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    texts = [f"{rng.choice(['http', 'HTTPS', ''])}://{host().upper()}{path()}{rng.choice(['', '?q=/a', '#x://y', '?a#b'])}" for _ in range(600)]
    texts += [None, "", "no scheme", "://", "http://", "http:///x", "a\nb://bb\n.com/x\ny", "http://com?x://a/x", *["http://bb.com/x/y"] * 200]
    # rules that no url can fit
    rules += [("com/x", "", "block"), ("com", "x", "block")]
    assert judged(spark, texts, rules) == {i: expected(u, rules) for i, u in enumerate(texts)}


def test_long_urls_empty_tables_and_rules(spark):
    long_ = "http://" + "a." * 50_000 + "com/" + "x/" * 50_000
    rules = [("com", "/x", "block"), ("com", "/x", "block"), ("a.com", "/" + "x/" * 40_000, "allow")]
    assert judged(spark, [long_], rules)[0] == expected(long_, rules)
    assert judged(spark, ["http://com/x"], []) == {0: ("com", "/x", None, "allow")}
    assert judged(spark, [], rules) == {}
    conflict = [("com", "/", "allow"), ("com", "/", "block")]
    assert judged(spark, ["http://com/x"], conflict)[0][3] == "block"


def test_filter_passes_every_key_and_few_others(spark):
    keys = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("key"))
    filter_, blocks = urls.blocked_filter(keys, "key", 50_000)
    asked = spark.range(100_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") < 50_000).alias("listed"), filter_.scalar().alias("bits"))
    found = dict(asked.where(urls.possible(F.col("bits"), F.col("key"), blocks)).groupBy("listed").count().collect())
    assert found[True] == 50_000 and found.get(False, 0) < 500
    assert urls.blocked_filter(keys, "key", 10**12)[1] == urls.MAX_BLOCKS


def test_op11(spark, data):
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in queries.op11_urls(spark, data).collect()}
    pages = spark.read.parquet(f"{data}/pages.parquet").collect()
    assert found == {p["page_id"]: expected(p["url"], queries.URL_RULES) for p in pages}
