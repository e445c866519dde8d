"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join of its possible hits.

A rule is a host, the start of a path and a verdict. Its canonical URL is host followed by path. It fits every
url of the host and its subdomains whose path starts with the rule's; of several that fit, the longest canonical
URL decides, then the longest host, then "block" before other verdicts in the order of their text. Rules listed
twice count once.

A url is asked for under every host that ends it, at a dot, joined with every start of its path of a length that
some rule has. The filter has blocks of 256 bits; a key sets or asks one bit in each of eight 32-bit parts of
one block. It is at most ``MAX_BLOCKS`` blocks (4 MB) whatever the number of rules: a longer list makes it
denser, so that more possible hits go on to the join, which decides alone. Rows without a possible hit never
leave their task. Those with one are asked once per distinct (host, path), so a url that a third of all rows
share is one row of the join; the verdicts come back by an equi join whose hot keys adaptive execution splits.

Only DataFrame functions; no Python runs on the rows.

Defined cases: null urls, and urls without ``://``, have an empty host and path, and fit no rule. Rules with a
null part are left out. Equal rows get equal verdicts, each its own row. Empty tables give no rows; an empty list
gives every row the default verdict. Columns of the input stay; clashing names of own columns are lengthened,
and a column called like an output column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slatecraft.llm.frames import unused

#: Blocks of 256 bits that the filter has at most.
MAX_BLOCKS = 1 << 17
#: Bits for each listed key, up to that size.
BITS_PER_KEY = 20
_WORDS = 4


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """A small frame (host, path, verdict) from tuples, made of literals."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    if not rows:
        return spark.createDataFrame([], "host string, path string, verdict string")
    return spark.range(1).select(F.inline(F.array(*rows)))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """Four longs with two bits each: eight 5-bit numbers of a second hash name a bit in each 32-bit part."""
    hashed = F.xxhash64(key, F.lit(1))
    bit = lambda part: F.shiftrightunsigned(hashed, 5 * part).bitwiseAND(F.lit(31)).cast("int")
    shifted = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), by)
    return [shifted(bit(2 * w)).bitwiseOR(shifted(bit(2 * w + 1) + 32)) for w in range(_WORDS)]


def blocked_filter(keys: DataFrame, name: str, n_keys: int) -> tuple[DataFrame, int]:
    """One row with the filter as an array of four longs a block, and its number of blocks.

    The array is made in one task from at most ``MAX_BLOCKS`` rows.
    """
    blocks = min(MAX_BLOCKS, max(1, 1 << math.ceil(math.log2(max(1, n_keys * BITS_PER_KEY / 256)))))
    spark = keys.sparkSession
    words = [f"w{i}" for i in range(_WORDS)]
    masks = [m.alias(w) for m, w in zip(_masks(F.col(name)), words)]
    none = spark.range(blocks).select(F.col("id").cast("int").alias("block"), *[F.lit(0).cast("long").alias(w) for w in words])
    set_ = keys.select(_block(F.col(name), blocks).alias("block"), *masks).unionByName(none)
    merged = set_.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in words])
    listed = F.array_sort(F.collect_list(F.struct("block", F.array(*words).alias("words"))))
    return merged.agg(F.flatten(F.transform(listed, lambda b: b["words"])).alias("bits")), blocks


def possible(bits: Column, key: Column, blocks: int) -> Column:
    """Whether all eight bits of a key are set in its block."""
    first = _block(key, blocks) * _WORDS
    tests = [F.get(bits, first + w).bitwiseAND(mask) == mask for w, mask in enumerate(_masks(key))]
    return tests[0] & tests[1] & tests[2] & tests[3]


def _ends(host: Column, most: int) -> Column:
    """The host and what follows each of its dots, of as many labels at most as some rule's host has."""
    labels = F.split(host, r"\.", -1)
    last = F.least(F.size(labels), F.lit(most))
    return F.transform(
        F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda n: F.call_function("substring_index", host, F.lit("."), -n),
    )


def judge(rows: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    kept = [c for c in rows.columns if c.lower() not in ("host", "path", "rule", "verdict") or c == url]
    host, path, hits, bits = unused(rows, "host_", "path_", "hits_", "bits_")

    best = F.min(F.struct(F.when(F.col("verdict") == "block", 0).otherwise(1), "verdict"))["verdict"]
    listed = (
        rules.select(F.col("host").cast("string"), F.col("path").cast("string"), F.col("verdict").cast("string"))
        .na.drop()
        # no url has another host or path, and with these parts the canonical url is unambiguous
        .where(~F.col("host").contains("/") & ((F.col("path") == "") | F.col("path").startswith("/")))
        .groupBy("host", "path")
        .agg(best.alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
    )
    shape = listed.agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
        F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
    ).first()
    filter_, blocks = blocked_filter(listed, "rule", shape["n"])
    lengths = F.array(*[F.lit(n) for n in shape["lengths"]]).cast("array<int>")

    def with_hits(frame: DataFrame) -> DataFrame:
        starts = F.filter(lengths, lambda n: n <= F.length(path))
        keys = F.flatten(
            F.transform(_ends(F.col(host), shape["labels"] or 0), lambda h: F.transform(starts, lambda n: F.concat(h, F.substring(F.col(path), F.lit(1), n))))
        )
        asked = frame.withColumn(bits, filter_.scalar())
        return asked.withColumn(hits, F.filter(keys, lambda k: possible(F.col(bits), k, blocks))).drop(bits)

    asked = with_hits(rows.select(*kept, host_of(F.col(url)).alias(host), path_of(F.col(url)).alias(path)))
    maybe = asked.where(F.size(hits) > 0).drop(hits)
    distinct = with_hits(maybe.select(host, path).distinct())
    longest = F.max(F.struct(F.length("rule").alias("length"), F.length("host").alias("host_length"), "rule", "verdict"))
    judged = (
        distinct.select(F.col(host).alias("of_host"), F.col(path).alias("of_path"), F.explode(hits).alias("rule"))
        .join(listed.select("rule", "host", "verdict"), "rule")
        .groupBy("of_host", "of_path")
        .agg(longest.alias("best"))
        .select("of_host", "of_path", "best.rule", "best.verdict")
    )
    plain = asked.where(F.size(hits) == 0).select(*kept, F.col(host).alias("host"), F.col(path).alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    maybe = asked.where(F.size(hits) > 0).drop(hits)
    joined = maybe.join(judged, (maybe[host] == judged["of_host"]) & (maybe[path] == judged["of_path"]), "left").select(
        *[maybe[c] for c in kept],
        maybe[host].alias("host"),
        maybe[path].alias("path"),
        judged["rule"],
        F.coalesce(judged["verdict"], F.lit(default)).alias("verdict"),
    )
    return plain.unionByName(joined)
