"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, units and names become typed placeholders, everything else lower-case words without
punctuation. A capitalised word at a sentence start may be a name or not: windows are made with it as a
word, and with it as a name unless it is a function word. Windows of canonical words of all documents meet the windows of the benchmark in a hash
join. Hits on one diagonal (document position less item position) are then checked for slot
consistency: a slot value of the item must stand for one value in the document throughout. So a
question copied with other names and numbers is caught, and a chance template is not.

A window needs ``least_words`` words that are no placeholders. Items shorter than a window have one window of their
own length, which is looked for in documents too. Items without any such window are found where all their words
stand, numbers and names as they are; those of fewer than ``least_words`` words only where they are the whole document.
Null or empty texts match nothing. Repeated
rows get the same verdict each. Empty tables give no leaks. Only id and text are read of either table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecraft.llm.frames import row_key, unused, whole_text, written
from slatecraft.llm.urls import blocked_filter, possible

WINDOWS = "array<struct<at:int,window:bigint>>"
#: Stands before a capitalised word at a sentence start.
START = "\x04"
WIDTH = 8
LEAST_WORDS = 5
#: Rows of benchmark windows up to which they are broadcast (16 bytes and an overhead each).
BROADCAST_WINDOWS = 500_000
# fixed values: words that are no names at a sentence start
FUNCTION_WORDS = (
    "the an and or but nor so yet if then than as at by for from in into of off on onto out over to under up with within without about above after again against along among around before behind below between beyond during "
    "except inside near since through until upon is are was were be been being am do does did done has have had can could may might must shall should will would not no nor he she it its they them their we us our you your my me "
    "his her hers him this that these those there here what which who whom whose when where why how many much some any each every all both most more less few other another such one two three while although because however also only "
    "once just now let suppose given find calculate compute determine solve show prove write choose select explain describe"
)
# fixed values: words that are units after a number
UNITS = "km|m|cm|mm|mi|miles?|feet|foot|ft|inch|inches|kg|g|mg|lb|lbs|pounds?|l|ml|litres?|liters?|gallons?|s|sec|seconds?|min|minutes?|h|hr|hours?|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|usd|eur|mph|kmh|c|f"


def canonical(text: Column) -> tuple[Column, Column]:
    """The words of a text as written, and as template words: two arrays of one length.

    Capitalised words at sentence starts are lower-case words after a mark: ``plain_word`` and ``as_name`` read them.
    """
    spaced = spaced_words(text)
    names = F.regexp_replace(spaced, "\\p{Lu}(?<=[^.!?:\\s] \\p{Lu})\\p{Ll}+(?:[-'’]\\p{L}+)*", "\x01")
    names = F.regexp_replace(names, "\\p{Lu}(?<=(?:^|[.!?:]) \\p{Lu})\\p{Ll}+(?:[-'’]\\p{L}+)*", f"{START}$0")
    numbers = F.when(text.rlike("[0-9]"), F.regexp_replace(F.regexp_replace(names, "(?<= )[^\\s\\p{L}\x01]{0,3}[0-9]\\S*(?= )", "\x02"), f"(?i)(?<=\x02 )(?:{UNITS})(?=[ .,;:!?])", "\x03")).otherwise(names)
    plain = F.regexp_replace(F.lower(numbers), f"[^\\p{{L}}\\p{{N}}\x01\x02\x03{START} ]+", "")
    return _split(spaced), _split(plain)


def spaced_words(text: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, "\\s{2,}|[^\\S ]", " ")), F.lit(" "))


def _split(spaced: Column) -> Column:
    return F.split(F.substring(spaced, 2, F.length(spaced) - 2), " ", -1)


def _is_slot(word: Column) -> Column:
    return word.isin("\x01", "\x02", "\x03")


def plain_word(word: Column) -> Column:
    """A template word, a sentence start being the word itself."""
    return F.when(word.startswith(START), F.substring(word, 2, F.length(word))).otherwise(word)


def as_name(word: Column) -> Column:
    """A template word, a sentence start being a name unless it is a function word."""
    return F.when(word.startswith(START) & ~word.isin([START + w for w in FUNCTION_WORDS.split()]), F.lit("\x01")).otherwise(plain_word(word))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for the row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def windows(words: Column, width: int, least_words: int = 0) -> Column:
    """at, window (a hash) of the template's windows, sentence starts being words, and those with them as names where that differs.

    Only windows with at least ``least_words`` words that are no placeholders, which is not looked at for 0.
    """

    def made(form) -> Column:
        def at_each(hashes: Column) -> Column:
            starts = F.sequence(F.lit(0), F.size(hashes) - F.lit(width))
            return F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get(hashes, i + F.lit(k)) for k in range(width)]).alias("window")))

        found = once(F.transform(words, lambda w: F.xxhash64(form(w))), at_each)
        if not least_words:
            return found
        literals = F.transform(words, lambda w: F.when(_is_slot(form(w)) | (w == ""), 0).otherwise(1))
        return once(literals, lambda n: F.filter(found, lambda x: F.aggregate(F.slice(n, x["at"] + 1, width), F.lit(0), lambda a, b: a + b) >= least_words))

    none = F.array().cast(WINDOWS)
    if least_words:
        both = F.array_union(made(plain_word), made(as_name))
    else:
        both = once(made(plain_word), lambda a: once(made(as_name), lambda b: F.concat(a, F.filter(b, lambda x: x["window"] != F.get(a, x["at"])["window"]))))
    return F.when(F.size(words) >= width, both).otherwise(none)


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, width: int, least_words: int) -> DataFrame:
    """window, item_id, item_key, item_at, width, exact: windows with enough words, or else those of the words as they are."""
    items = benchmark.select(F.col(item_id).alias("item_id"), row_key(F.col(item_id), F.col(text)).alias("item_key"), whole_text(text).alias("text")).dropDuplicates(["item_key"])
    items = written(items.select("item_id", "item_key", canonical(F.col("text"))[1].alias("words"), exact_words(F.col("text")).alias("exact_words")))
    size = F.size("words")
    long = F.when(size >= width, windows(F.col("words"), width, least_words))
    for n in range(least_words, width):
        long = long.when(size == n, windows(F.col("words"), n, least_words))
    items = items.withColumn("made", F.coalesce(long, F.array().cast(WINDOWS))).withColumn("exact", F.size("made") == 0)
    plain = F.when(size >= width, exact_windows(F.col("exact_words"), width))
    for n in range(least_words, width):
        plain = plain.when(size == n, exact_windows(F.col("exact_words"), n))
    plain = plain.otherwise(whole_window(F.col("exact_words")))
    made = F.when(F.col("exact") & (F.array_join("exact_words", "") != ""), plain).otherwise(F.col("made"))
    found = items.select("item_id", "item_key", "exact", F.least(size, F.lit(width)).alias("width"), F.inline(made))
    return found.select("window", "item_id", "item_key", F.col("at").alias("item_at"), "width", "exact")


def exact_words(text: Column) -> Column:
    """The words in lower case and without punctuation, as many as template words."""
    return _split(F.regexp_replace(F.lower(spaced_words(text)), "[^\\p{L}\\p{N} ]+", ""))


def exact_windows(words: Column, width: int) -> Column:
    """at, window of the words as they are."""
    made = once(words, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - F.lit(width)), lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit("exact"), F.array_join(F.slice(w, i + 1, width), " ")).alias("window"))))
    return F.when(F.size(words) >= width, made).otherwise(F.array().cast(WINDOWS))


def whole_window(words: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(F.lit("whole"), F.array_join(words, " ")).alias("window"))).cast(WINDOWS)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """A row for each document row and item that it leaks.

    row_key, doc_id, item_id, n_windows that match, n_item_windows, verbatim (all slot values are equal).
    """
    known = written(benchmark_windows(benchmark, item_id, item_text, width, least_words))
    distinct = known.select("window").distinct()
    if known.count() <= BROADCAST_WINDOWS:
        distinct = F.broadcast(distinct)
    rows = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), whole_text(text).alias("text")).where("text <> ''")
    kinds = [(r["width"], r["exact"]) for r in known.select("width", "exact").distinct().collect()]  # two for each width at most
    words = rows.select("row_key", canonical(F.col("text"))[1].alias("words"), (exact_words(F.col("text")) if any(e for _, e in kinds) else F.lit(None).cast("array<string>")).alias("exact_words"))
    made = [lambda w, e, n=n: windows(w, n) for n in sorted({n for n, e in kinds if not e})]
    made += [lambda w, e, n=n: exact_windows(e, n) for n in sorted({n for n, e in kinds if e and n >= least_words})]
    if any(e and n < least_words for n, e in kinds):
        made.append(lambda w, e: F.when(F.size(e) < least_words, whole_window(e)).otherwise(F.array().cast(WINDOWS)))
    every = once(F.struct("words", "exact_words"), lambda r: F.concat(F.array().cast(WINDOWS), *[m(r["words"], r["exact_words"]) for m in made]))
    found = words.select("row_key", F.inline(every)).withColumnRenamed("at", "doc_at")
    hits = found.join(distinct, "window", "left_semi").distinct()
    hits = written(hits)
    pairs = hits.join(known, "window").groupBy("row_key", "item_key", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).agg(F.first("item_id").alias("item_id"), F.first("width").alias("width"), F.first("exact").alias("exact"), F.collect_set(F.struct("doc_at", "item_at")).alias("at"))
    raw, plain = canonical(F.col("text"))
    # a Bloom filter of the keys with hits: other texts stay where they are
    keys = written(hits.select("row_key").distinct())
    filter_, blocks = blocked_filter(keys, "row_key", keys.count())
    hit_docs = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), filter_.scalar().alias("bits"))
    hit_docs = hit_docs.where(possible(F.col("bits"), F.col("row_key"), blocks)).drop("bits").join(keys, "row_key", "left_semi")
    hit_docs = hit_docs.select("row_key", "doc_id", F.monotonically_increasing_id().alias("row"), raw.alias("doc_raw"), plain.alias("doc_plain"))
    items = benchmark.select(row_key(F.col(item_id), F.col(item_text)).alias("item_key"), whole_text(item_text).alias("text")).dropDuplicates(["item_key"])
    items = items.select("item_key", canonical(F.col("text"))[0].alias("item_raw"))

    def slots(at: Column) -> Column:
        places = F.sequence(F.lit(0), F.col("width") - 1)
        both = F.transform(places, lambda k: F.struct(as_name(F.get("doc_plain", at["doc_at"] + k)).alias("kind"), _value(F.get("item_raw", at["item_at"] + k)).alias("item"), _value(F.get("doc_raw", at["doc_at"] + k)).alias("doc")))
        return F.filter(both, lambda s: _is_slot(s["kind"]))

    checked = (
        pairs.join(items, "item_key")
        .join(hit_docs, "row_key")
        .withColumn("slots", F.array_distinct(F.flatten(F.transform("at", slots))))
        .withColumn("values", F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["item"]))))
        .where(F.col("exact") | (F.size("slots") == F.size("values")))
        .withColumn("verbatim", F.col("exact") | F.forall("slots", lambda s: s["item"] == s["doc"]))
    )
    sizes = known.groupBy("item_key").agg(F.count_distinct("item_at").alias("n_item_windows"))
    return (
        checked.groupBy("row", "row_key", "doc_id", "item_key")
        .agg(F.first("item_id").alias("item_id"), F.max(F.size("at")).cast("long").alias("n_windows"), F.max("verbatim").alias("verbatim"), F.first("exact").alias("exact"))
        .join(sizes, "item_key")
        .where(~F.col("exact") | (F.col("n_windows") == F.col("n_item_windows")))
        .select("row_key", "doc_id", "item_id", "n_windows", "n_item_windows", "verbatim")
    )


def _value(word: Column) -> Column:
    return F.regexp_replace(word, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that leak no item, with all their columns.

    A Bloom filter of the leaking keys lets all other rows pass where they are; only possible hits are joined.
    """
    key, bits = unused(docs, "_key", "_bits")
    bad = written(leaks(docs, benchmark, doc_id=doc_id, text=text, **options).select(F.col("row_key").alias("bad_key")).distinct())
    filter_, blocks = blocked_filter(bad, "bad_key", bad.count())
    keyed = docs.withColumn(key, row_key(F.col(doc_id), F.col(text))).withColumn(bits, filter_.scalar())
    maybe = possible(F.col(bits), F.col(key), blocks)
    names = docs.columns
    clean = keyed.where(~maybe).select(*names)
    checked = keyed.where(maybe).drop(bits)
    return clean.unionByName(checked.join(bad, checked[key] == bad["bad_key"], "left_anti").select(*names))
