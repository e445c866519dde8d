"""Secret scan by corpus-wide ownership frequency, in DataFrame functions only.

Three base kinds are found in every whole text: assignments, access keys and hexadecimal runs. Beside
them stand bare tokens: long runs of letters and digits that no base span covers. Every candidate value
is hashed and counted over the whole corpus by distinct repositories and distinct owners. A value that
many owners share is an example copied around; one that stays with few is a live-looking credential.
Base spans always stay; a bare token becomes a span only where it is live.

Null or empty texts have no spans. Null owners and repositories count as one owner or repository each.
Repeated rows get the same spans each; a table without rows gives none. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecraft.llm.frames import row_key, unused, whole_text, written

# fixed values: the base patterns; letters of the first in either case
KEYWORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = KEYWORD + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs are maximal, so a least length inside the pattern drops just the short matches.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
BARE = "[A-Za-z0-9+/_=-]{20,}"

KINDS = {"assign": (ASSIGN, 8), "access": (ACCESS, 16), "hex": (HEX, 32), "bare": (BARE, 20)}
ORDER = list(KINDS)
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _found(text: Column, kind: str) -> Column:
    """Spans of a kind. Each piece is what lies between two matches, and the second match.

    A piece starts where the last one ended, so the rest after the last match is searched once.
    """
    pattern, least = KINDS[kind]
    pieces = F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(f"(?s)\\G.*?{pattern.replace('([', '(?:[')}"), F.lit(0)))

    # bound as elements, so that each is worked out once
    parts = F.transform(
        pieces,
        lambda p: F.struct(
            F.length(p).alias("n"),
            F.regexp_extract(p, pattern, 0).alias("whole"),
            (F.regexp_extract(p, pattern, 1) if kind == "assign" else F.lit(None).cast("string")).alias("value"),
        ),
    )

    def step(state: Column, part: Column) -> Column:
        whole = part["whole"]
        value = part["value"] if kind == "assign" else whole
        end = state["at"] + part["n"]
        span = F.struct(
            (end - F.length(whole)).cast("int").alias("start"),
            F.lit(ORDER.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            end.cast("int").alias("end"),
            value.alias("value"),
        )
        good = F.length(value) >= least
        if kind == "bare":
            good = good & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        spans = F.when(good, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.coalesce(F.aggregate(parts, start, step)["spans"], F.array().cast(SPAN))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per row of ``docs``: row_key, doc_id, owner, repository, base and bare spans (with hashed values)."""
    rows = docs.select(
        row_key(F.col(doc_id), F.col(text)).alias("row_key"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        row_key(*[F.col(c) for c in repository]).alias("repository"),
        whole_text(text).alias("text"),
    )
    keys = ("row_key", "doc_id", "owner", "repository")
    # inline() keeps the searches from being repeated wherever their results are used
    found = rows.select(*keys, F.inline(F.array(F.struct(*[_found(F.col("text"), k).alias(k) for k in ORDER]))))
    found = found.select(*keys, F.inline(F.array(F.struct(F.sort_array(F.concat("assign", "access", "hex")).alias("base"), "bare"))))
    free = F.filter("bare", lambda b: ~F.exists("base", lambda a: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    hashed = lambda s: s.withField("value", F.sha2(s["value"], 256))
    return (
        found.withColumn("bare", free)
        .select("row_key", "doc_id", "owner", "repository", F.transform("base", hashed).alias("base"), F.transform("bare", hashed).alias("bare"))
    )


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate value; copies are merged before the shuffle."""
    values = found.select("owner", "repository", F.explode(F.array_distinct(F.transform(F.concat("base", "bare"), lambda s: s["value"]))).alias("value"))
    per_repository = values.groupBy("value", "owner", "repository").agg(F.count("*").alias("rows"))
    per_owner = per_repository.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("rows").alias("rows"))
    return per_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("rows").alias("rows"))


def scan(docs: DataFrame, most_owners: int = 2, most_repositories: int = 4, **columns) -> DataFrame:
    """Row_key, doc_id and the spans of every row: start, end, kind, and whether the value is live.

    A value is live up to ``most_owners`` distinct owners and ``most_repositories`` distinct repositories.
    """
    found = written(candidates(docs, **columns))
    counts = ownership(found)
    marked = (
        found.select("row_key", F.explode(F.concat("base", "bare")).alias("span"))
        .distinct()
        .select("row_key", "span", F.col("span.value").alias("value"))
        .join(counts.select("value", "owners", "repositories"), "value")
        .select("row_key", F.col("span").dropFields("value").withField("live", (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)).alias("span"))
        .where("span.kind <> 'bare' OR span.live")
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,live:boolean>>")
    return found.select("row_key", "doc_id").join(marked, "row_key", "left").select("row_key", "doc_id", F.coalesce("spans", none).alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by a mark; spans that overlap share one."""

    def step(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        kept = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(apart, kept).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = F.aggregate(spans, start, step)
    return F.concat(end["out"], F.substring(text, end["at"] + 1, F.greatest(F.length(text) - end["at"], F.lit(0))))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, their columns unchanged but for texts without secrets (and ``n_chars``, if there, to fit).

    Live spans go; spans of widely copied examples stay, but for base kinds, which always go.
    """
    key, found = unused(docs, "_key", "_spans")
    spans = scan(docs, doc_id=doc_id, text=text, **options).where(F.size("spans") > 0).select(F.col("row_key").alias(key), F.col("spans").alias(found)).dropDuplicates([key])
    joined = docs.withColumn(key, row_key(F.col(doc_id), F.col(text))).join(spans, key, "left")
    clean = F.when(F.col(found).isNotNull(), redacted(F.col(text), F.col(found))).otherwise(F.col(text))
    changed = {text: clean.alias(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(found).isNotNull(), F.length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars")
    return joined.select(*[changed.get(c, F.col(c)) for c in docs.columns])
