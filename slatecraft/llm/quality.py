"""Quality classifier: interpolated modified Kneser-Ney model of bytes, trained on trusted texts.

Every other trusted document, by a hash of its id, trains the model, whole; the others give the thresholds. Counts,
continuation counts, discounts, context totals and the scores of windows are tables sharded by n-gram: blocks of documents
hand in their distinct windows, compressed by shard, joins score these once, the scores go back to the blocks in the order of their windows, and each
block adds up its documents. No table of the model is held as a whole anywhere. The threshold of a language is a quantile of the scores of all its trusted documents outside
the training half; with fewer than ``LEAST_HELD`` of these it is at least the quantile over all languages, and at least the
language's mean and the quantile of distances from the means of all; languages without any use the largest threshold. Documents above it are rejected.

A score is the mean negative log probability of a byte, drawn towards the language's trusted mean as if
``PRIOR`` bytes of such text stood before it: a few words are no proof. Null or empty texts are scored by their
end alone. Null languages form one language. A document counts as trusted if any label row says so. Without
trusted rows nothing is rejected. Repeated rows are scored each; no rows give none; extra columns are kept by ``keep``.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecraft.llm.bytegrams import Lookup, by_text, chunks, dealt, distinct, encoded, keys, restored, shard, squeezed, stored, unsqueezed
from slatecraft.llm.frames import bucketed, unused, whole_text, written

WIDTH = 6
#: Bounds of ``sample_of`` alone, which trains nothing here.
SAMPLE_DOCS = 3000
SAMPLE_BYTES = 4_000_000
#: Bytes of text to a block.
BLOCK_BYTES = 32_000_000
#: Buckets of the table of blocks; Spark allows 100,000.
MOST_BUCKETS = 50_000
#: Windows that blocks ask for in a shard.
SHARD_ROWS = 1_000_000
#: Orders of at most 65,536 n-grams, which a join may broadcast.
SMALL_ORDERS = 2
QUANTILE = 0.99
PRIOR = 60
#: Held-out documents of a language from which on their quantile stands alone: below, it is their maximum.
LEAST_HELD = 100


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()


def training_of(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """trusted_id, text: the training half of the trusted documents, whole; of a repeated id the smallest text."""
    half = trusted.where(F.pmod(F.xxhash64("trusted_id", F.lit(3)), F.lit(2)) == 0)
    rows = docs.select(F.col(doc_id).cast("long").alias("trusted_id"), whole_text(text).alias("text"))
    return rows.join(half, "trusted_id", "left_semi").groupBy("trusted_id").agg(F.min("text").alias("text"))


def sample_of(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """trusted_id, text of the sample: trusted documents in the order of a hash, up to both bounds; texts over a hundredth of the bytes last.

    Every other one is left for the thresholds.
    """
    ids = [r[0] for r in trusted.where(F.pmod(F.xxhash64("trusted_id", F.lit(3)), F.lit(2)) == 0).orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(SAMPLE_DOCS).collect()]
    few = docs.where(F.col(doc_id).isin(ids)).select(F.col(doc_id).cast("long").alias("trusted_id"), whole_text(text).alias("text"))
    few = written(few)
    # at most SAMPLE_DOCS ids; long texts come last, by size, so one that does not fit keeps none out that would
    long = F.when(F.col("n") > SAMPLE_BYTES // 100, F.col("n")).otherwise(0)
    order = Window.orderBy(long, F.xxhash64("trusted_id"), "trusted_id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = few.select("trusted_id", F.octet_length("text").alias("n")).groupBy("trusted_id").agg(F.max("n").alias("n"))
    within = sizes.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") <= SAMPLE_BYTES).select("trusted_id")
    return few.join(within, "trusted_id").dropDuplicates(["trusted_id"])


def counts(sample: DataFrame, width: int) -> DataFrame:
    def grams(batches):
        import pyarrow as pa

        for batch in batches:
            for run in chunks(encoded(batch.column("text"))):
                key, n = np.unique(keys(run, width)[0], return_counts=True)
                yield pa.record_batch({"key": pa.array(key, pa.int64()), "c": pa.array(n, pa.int64())})

    return sample.select("text").mapInArrow(grams, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def train(sample: DataFrame, width: int = WIDTH) -> list[tuple[DataFrame, DataFrame]]:
    """By order, highest first: key, v (n-grams, their log probabilities); context, v (log weights of the next lower order)."""
    tables = {width: written(counts(sample, width))}
    for j in range(width - 1, 0, -1):  # continuation counts: distinct bytes before
        tables[j] = written(tables[j + 1].groupBy(F.col("key").bitwiseAND((1 << 8 * j) - 1).alias("key")).agg(F.count("*").alias("c")))
    lower, model = None, []
    for j in range(1, width + 1):
        n = tables[j].agg(*[F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (x or 0 for x in n)
        y = n1 / max(1, n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / max(1, n1), 2 - 3 * y * n3 / max(1, n2), 3 - 4 * y * n4 / max(1, n3))
        d1, d2, d3 = (min(max(d, 0.1), top) for d, top in zip(raw, (0.95, 1.9, 2.9)))
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        grams = tables[j].select("key", "c", cut.alias("cut"), F.shiftright("key", 8).alias("context"))
        contexts = written(grams.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("weight")))
        # merged, not broadcast: a dozen hash tables of the sample's n-grams would meet in the driver
        joined = grams.join(contexts.hint("merge"), "context")
        if lower is None:
            p = joined.select("key", ((F.col("c") - F.col("cut")) / F.col("total") + F.col("weight") / 256).alias("p"))
        else:
            joined = joined.withColumn("short", F.col("key").bitwiseAND((1 << 8 * (j - 1)) - 1)).join(lower.select(F.col("key").alias("short"), F.col("p").alias("q")).hint("merge"), "short")
            p = joined.select("key", ((F.col("c") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("q")).alias("p"))
        lower = written(p)
        model.append((lower.select("key", F.log("p").cast("float").alias("v")), contexts.select("context", F.log("weight").cast("float").alias("v"))))
    return model[::-1]


def blocks(docs: DataFrame, text: str, width: int) -> DataFrame:
    """block, run, rows, n, keys: the rows of each run of about a megabyte of texts, compressed; once for each block its distinct windows.

    A block is what lies together in a partition, so texts move nowhere. The table is written once, in buckets by block:
    what meets the rows again by block is dealt to them, and they stay where they are.
    """
    total = docs.agg(F.sum(F.octet_length(whole_text(text)))).first()[0] or 0
    number = max(1, -(-total // BLOCK_BYTES))

    def pack(batches):
        import pyarrow as pa

        block, run, held, parts = TaskContext.get().partitionId() << 32, 0, 0, []
        schema = pa.schema([("block", pa.int64()), ("run", pa.int32()), ("rows", pa.binary()), ("n", pa.int64()), ("keys", pa.binary())])

        def windows():
            found = distinct(np.concatenate(parts))
            return pa.record_batch([[block], [None], [None], [len(found)], [squeezed(np.diff(found, prepend=0))]], schema=schema)

        for batch in batches:
            start = 0
            for texts in chunks(encoded(batch.column(text))):
                yield pa.record_batch([[block], [run], [stored(batch.slice(start, len(texts)))], [None], [None]], schema=schema)
                start += len(texts)
                run += 1
                held += sum(map(len, texts))
                parts.append(distinct(keys(texts, width)[0]))
                if len(parts) > 8:
                    parts = [distinct(np.concatenate(parts))]
                if held >= BLOCK_BYTES:
                    yield windows()
                    block, run, held, parts = block + 1, 0, 0, []
        if parts:
            yield windows()

    packs = docs.coalesce(number).mapInArrow(pack, "block long, run int, rows binary, n long, keys binary")
    return bucketed(packs, "block", min(number, MOST_BUCKETS))


def shards_of(packs: DataFrame) -> int:
    return max(1, -(-(packs.agg(F.sum("n")).first()[0] or 0) // SHARD_ROWS))


def asked_of(packs: DataFrame, shards: int) -> DataFrame:
    """shard, block, n, keys: the distinct windows of each block, a row for each shard of them, compressed."""

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            for block, n, data in zip(*(column.to_pylist() for column in batch.columns)):
                key = np.cumsum(unsqueezed(data, n, np.int64))
                parts = dealt(key, shards)
                yield pa.record_batch(
                    {
                        "shard": pa.array([s for s, _ in parts], pa.int64()),
                        "block": pa.array(np.full(len(parts), block, np.int64)),
                        "n": pa.array([len(at) for _, at in parts], pa.int64()),
                        "keys": pa.array([squeezed(np.diff(key[at], prepend=0)) for _, at in parts], pa.binary()),
                    }
                )

    return packs.where("keys IS NOT NULL").select("block", "n", "keys").mapInArrow(deal, "shard long, block long, n long, keys binary")


def windows_of(asked: DataFrame) -> DataFrame:
    """key: every window that some block asks for, once."""

    def once(asks):
        import pyarrow as pa

        found = [np.cumsum(unsqueezed(data, n, np.int64)) for n, data in zip(asks.column("n").to_pylist(), asks.column("keys").to_pylist())]
        return pa.table({"key": pa.array(distinct(np.concatenate(found)))})

    return asked.groupBy("shard").applyInArrow(once, "key long")


def answers_of(asked: DataFrame, scores: DataFrame, shards: int) -> DataFrame:
    """shard, block, numbers: for each row of ``asked`` the lp of its windows, in their order, compressed; the block has the windows."""

    def look_up(asks, found):
        import pyarrow as pa

        key, lp = found.column("key").to_numpy(), found.column("lp").to_numpy()
        order = np.argsort(key)
        key, lp = key[order], lp[order]
        numbers = [squeezed(lp[np.searchsorted(key, np.cumsum(unsqueezed(data, n, np.int64)))]) for n, data in zip(asks.column("n").to_pylist(), asks.column("keys").to_pylist())]
        return pa.table({"shard": asks.column("shard"), "block": asks.column("block"), "numbers": pa.array(numbers, pa.binary())})

    there = scores.select(shard(F.col("key"), shards).alias("shard"), "key", "lp")
    return asked.groupBy("shard").cogroup(there.groupBy("shard")).applyInArrow(look_up, "shard long, block long, numbers binary")


def window_scores(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """key, lp: log probability of the last byte of each window; the longest n-gram that is known decides."""
    open_, out = asked.select("key", F.lit(0.0).alias("lp")), None
    for j, (grams, contexts) in zip(range(len(model), 0, -1), model):
        hint = "merge" if j > SMALL_ORDERS else "broadcast"
        # windows are as wide as the longest n-grams: these are looked up by key, which the windows lie by already
        short = F.col("key") if j == len(model) else F.col("key").bitwiseAND((1 << 8 * j) - 1)
        here = written(open_.withColumn("short", short).join(grams.select(F.col("key").alias("short"), "v").hint(hint), "short", "left").select("key", "lp", "v"))
        done = here.where("v IS NOT NULL").select("key", (F.col("lp") + F.col("v").cast("double")).alias("lp"))
        out = done if out is None else out.union(done)
        missed = here.where("v IS NULL").select("key", "lp", F.shiftright(short, 8).alias("context"))
        weight = F.coalesce(F.col("v").cast("double"), F.lit(0.0))
        open_ = missed.join(contexts.hint(hint), "context", "left").select("key", (F.col("lp") + weight).alias("lp"))
    return out.union(open_.select("key", (F.col("lp") + float(np.log(1 / 256))).alias("lp")))


def scored_blocks(packs: DataFrame, model: list[tuple[DataFrame, DataFrame]], text: str, columns: list[T.StructField], loss: str, size: str, place: tuple[str, ...] = ()) -> DataFrame:
    """Some columns of the documents in ``blocks``, with the text's loss and bytes; ``place`` names block, run and position in it."""
    shards = shards_of(packs)
    asked = asked_of(packs, shards)
    answers = answers_of(asked, window_scores(windows_of(asked), model), shards)
    width, names = len(model), [f.name for f in columns]

    def add_up(texts, found):
        import pyarrow as pa
        import pyarrow.compute as pc

        own = texts.filter(pc.is_valid(texts.column("keys")))  # a row for each block
        key = np.cumsum(unsqueezed(own.column("keys")[0].as_py(), own.column("n")[0].as_py(), np.int64))
        lp, places = np.empty(len(key)), dict(dealt(key, shards))
        for s, numbers in zip(found.column("shard").to_pylist(), found.column("numbers")):
            lp[places[s]] = unsqueezed(numbers.as_py(), len(places[s]), np.float64)
        del places
        table = Lookup(key)
        out = []
        texts = texts.filter(pc.is_valid(texts.column("rows")))
        for block, run, data in zip(*(texts.column(c) for c in ("block", "run", "rows"))):  # one at a time: a list would hold them twice
            rows = restored(data.as_buffer())
            wanted, lengths = keys(list(encoded(rows.column(text))), width)
            here = rows.select(names).append_column(loss, pa.array(-by_text(lp[table.at(wanted)], lengths), pa.float64())).append_column(size, pa.array(lengths, pa.int64()))
            for name, values in zip(place, (np.full(len(lengths), block.as_py(), np.int64), np.full(len(lengths), run.as_py(), np.int32), np.arange(len(lengths), dtype=np.int32))):
                here = here.append_column(name, pa.array(values))
            out.append(here)
        return pa.concat_tables(out)

    kinds = [T.LongType(), T.IntegerType(), T.IntegerType()]
    schema = T.StructType([*columns, T.StructField(loss, T.DoubleType()), T.StructField(size, T.LongType()), *map(T.StructField, place, kinds)])
    return packs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, schema)


def scored(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]], text: str = "text") -> DataFrame:
    """The columns of ``docs``, with the text's negative log probability and its bytes, the end counted."""
    return scored_blocks(blocks(docs, text, len(model)), model, text, docs.schema.fields, *unused(docs, "_loss", "_bytes"))


def thresholds_of(scores: DataFrame, trusted: DataFrame, training: DataFrame, quantile: float) -> DataFrame:
    """lang, mean, threshold by the trusted documents that trained nothing; ``scores`` has doc_id, lang, loss, bytes."""
    judged = scores.join(trusted, scores["doc_id"] == trusted["trusted_id"], "left_semi").join(training.select(F.col("trusted_id").alias("doc_id")), "doc_id", "left_anti")
    means = written(judged.groupBy("lang").agg((F.sum("loss") / F.sum("bytes")).alias("mean"))).where("mean IS NOT NULL")
    drawn = (F.col("loss") + PRIOR * F.col("mean")) / (F.col("bytes") + PRIOR)
    held = judged.join(means, "lang").select("lang", "mean", drawn.alias("drawn"))
    every = held.agg(F.percentile_approx("drawn", quantile, 100_000).alias("any"), F.percentile_approx(F.col("drawn") - F.col("mean"), quantile, 100_000).alias("far")).first()
    own = held.groupBy("lang").agg(F.first("mean").alias("mean"), F.percentile_approx("drawn", quantile, 100_000).alias("own"), F.count("*").alias("n"))
    least = F.greatest("own", F.lit(every["any"]).cast("double"), F.col("mean") + F.lit(every["far"]).cast("double"))
    return written(own.select("lang", "mean", F.when(F.col("n") < LEAST_HELD, least).otherwise(F.col("own")).alias("threshold")))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Ids of the trusted documents, the training half and the model."""
    trusted = written(trusted_ids(labels))
    training = training_of(docs, trusted, doc_id, text)  # texts are read from it once, later its ids alone
    return trusted, training, train(training)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Scores by document (doc_id, lang, loss, bytes), thresholds by language (lang, mean, threshold), and the model."""
    trusted, training, model = fit(docs, labels, doc_id, text)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.col(text).cast("string").alias("text"))
    judged = [f for f in narrow.schema if f.name != "text"]  # texts stay in their blocks
    scores = written(scored_blocks(blocks(narrow, "text", len(model)), model, "text", judged, "loss", "bytes"))
    return scores, thresholds_of(scores, trusted, training, quantile), model


def verdicts(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Adds perplexity (by byte), threshold (as perplexity) and kept to rows with lang, loss, bytes."""
    every = thresholds.agg(F.avg("mean").alias("any_mean"), F.max("threshold").alias("any_threshold")).first()
    mean, top = F.coalesce("mean", F.lit(every["any_mean"]).cast("double")), F.coalesce("threshold", F.lit(every["any_threshold"]).cast("double"))
    drawn = F.exp((F.col("loss") + PRIOR * mean) / (F.col("bytes") + PRIOR))
    return scores.join(thresholds, "lang", "left").withColumn("perplexity", drawn).withColumn("threshold", F.exp(top)).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).drop("mean")


def keep(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    trusted, training, model = fit(docs, labels, doc_id, text)
    packs = blocks(docs, text, len(model))
    names = unused(docs, "_loss", "_bytes", "_block", "_run", "_at")
    loss, size, block, run, at = (F.col(c) for c in names)
    judged = [f for f in docs.schema if f.name.lower() in (doc_id.lower(), lang.lower())]
    lang_of = F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang")
    found = scored_blocks(packs, model, text, judged, *names[:2], names[2:]).select(
        F.col(doc_id).cast("long").alias("doc_id"), lang_of, loss.alias("loss"), size.alias("bytes"), block.alias("block"), run.alias("run"), at.alias("at")
    )
    scores = written(found)
    thresholds = thresholds_of(scores.select("doc_id", "lang", "loss", "bytes"), trusted, training, quantile)
    rejected = verdicts(scores.drop("doc_id"), thresholds).where("NOT kept").groupBy("block").agg(F.collect_list(F.struct("run", "at")).alias("gone"))
    # written, so that it has no partitions of its own, by which the texts would be dealt
    runs = packs.where("rows IS NOT NULL").select("block", "run", "rows").join(written(rejected).hint("merge"), "block", "left")
    gone = F.transform(F.filter("gone", lambda g: g["run"] == F.col("run")), lambda g: g["at"])

    def left(batches):
        import pyarrow as pa

        for batch in batches:
            for data, at in zip(batch.column("rows"), batch.column("gone")):  # a run at a time: no block is ever held as text
                here = restored(data.as_buffer())
                stays = np.ones(here.num_rows, bool)
                stays[at.as_py() or []] = False
                yield from here.filter(pa.array(stays)).to_batches()

    return runs.select("rows", gone.alias("gone")).mapInArrow(left, docs.schema)
