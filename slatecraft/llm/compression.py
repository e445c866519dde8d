"""Language-model scores by prediction by partial matching over bytes.

A pretrained static trie of byte contexts: each context knows the bytes seen after it. A byte is coded in the
longest context; where it is new there, an escape (method C: as many chances as distinct bytes seen) leads to
the next shorter context, whose bytes already excluded no longer count; at last all bytes not yet seen are alike.
The trie is a set of tables sharded by context. All work is on distinct windows of bytes: blocks of documents
hand in their distinct windows and words, joins answer them, the answers go back packed, and each block adds up its documents.

A token is a word or the end. Texts have A-Z lower-cased. Null texts are empty; null ids count as empty texts in the split. Repeated rows are scored and counted each. Without training
documents bytes are alike. No rows give none; only id and text are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.llm.bytegrams import Lookup, by_text, chunks, encoded, keys, packed, squeezed, tables, unpacked, unsqueezed
from slatecraft.llm.frames import whole_text, written

#: Bytes of context.
DEPTH = 5
#: Bytes of text to a block.
BLOCK_BYTES = 24_000_000
END_WORD = "\n"


def split_rows(docs: DataFrame, doc_id: str, text: str, folds: int, held_out: int) -> DataFrame:
    """doc_id, text, held_out, block: blocks of about BLOCK_BYTES, by a hash of id and text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == held_out).alias("held_out"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-total // BLOCK_BYTES)))).cast("int"))


def windows(rows: DataFrame) -> DataFrame:
    """block, key or word, n: distinct windows and words of each block and how often training documents have them."""

    def distinct(key, group):
        import pyarrow as pa
        import pyarrow.compute as pc

        block = key[0].as_py()
        grams: dict[bool, list] = {True: [], False: []}
        words: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for train in (True, False):
            part = group.filter(pc.not_equal(group.column("held_out"), train)).column("text")
            for run in chunks(t.lower() for t in encoded(part)):
                grams[train].append(np.unique(keys(run, DEPTH + 1)[0], return_counts=True))
                for t in run:
                    words[train].update(t.split())
                words[train][END_WORD.encode()] += len(run)
                if len(grams[train]) > 8:
                    grams[train] = [_summed(grams[train])]
        a, n = _summed(grams[True])
        b, _ = _summed(grams[False])
        rest = np.setdiff1d(b, a, assume_unique=True)
        new = words[False].keys() - words[True].keys()
        # Arrow, not pandas: a block has millions of windows, and a pandas column with nulls holds them several times
        spelled = [*words[True], *new]
        made = [
            (pa.array(np.concatenate([a, rest]), pa.int64()), pa.nulls(len(a) + len(rest), pa.binary()), pa.array(np.concatenate([n, np.zeros(len(rest), np.int64)]), pa.int64())),
            (pa.nulls(len(spelled), pa.int64()), pa.array(spelled, pa.binary()), pa.array([*words[True].values(), *[0] * len(new)], pa.int64())),
        ]
        return pa.concat_tables([pa.table({"block": pa.array(np.full(len(k), block, np.int32)), "key": k, "word": w, "n": c}) for k, w, c in made])

    return rows.groupBy("block").applyInArrow(distinct, "block int, key long, word binary, n long")


def packed_words(answers: DataFrame) -> DataFrame:
    """block, n, words, numbers: block, word and c of each task as a row for each of its blocks, with spaces between the words."""

    def pack(batches):
        import pyarrow as pa

        for table in tables(batches):
            block, c = (table.column(x).to_numpy() for x in ("block", "c"))
            order = np.argsort(block, kind="stable")
            table, block, c = table.take(pa.array(order)), block[order], c[order]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
            ends = np.append(starts[1:], len(block))
            yield pa.record_batch(
                {
                    "block": pa.array(block[starts]),
                    "n": pa.array(ends - starts, pa.int64()),
                    "words": pa.array([b" ".join(table.column("word")[i:j].to_pylist()) for i, j in zip(starts, ends)], pa.binary()),
                    "numbers": pa.array([squeezed(c[i:j]) for i, j in zip(starts, ends)], pa.binary()),
                }
            )

    return answers.select("block", "word", "c").mapInArrow(pack, "block int, n long, words binary, numbers binary")


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    values, inverse = np.unique(key, return_inverse=True)
    return values, np.bincount(inverse, n, len(values)).astype(np.int64)


def gram_scores(grams: DataFrame) -> DataFrame:
    """key, lp: log10 probability of the last byte of every window after the ones before; ``grams`` has key and n."""
    mask = lambda width: (1 << 8 * width) - 1
    seen = {DEPTH: written(grams.where("n > 0"))}
    for j in range(DEPTH - 1, -1, -1):
        seen[j] = written(seen[j + 1].groupBy(F.col("key").bitwiseAND(mask(j + 1)).alias("key")).agg(F.sum("n").alias("n")))
    contexts = {}
    for j in range(DEPTH + 1):
        own = seen[j].withColumn("context", F.shiftright("key", 8))
        if j:  # what the bytes seen here count for in the next shorter context
            shorter = seen[j - 1].select(F.col("key").alias("short"), F.col("n").alias("below"))
            own = own.withColumn("short", F.col("key").bitwiseAND(mask(j))).join(shorter, "short")
        else:
            own = own.withColumn("below", F.lit(0).cast("long"))
        contexts[j] = written(own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("below").alias("excluded")))
    top = seen[DEPTH].withColumn("context", F.shiftright("key", 8)).join(contexts[DEPTH], "context").select("key", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("lp"))
    open_ = grams.where("n = 0").select("key", F.lit(0.0).alias("lp"), F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("gone_kinds"))
    done = [top]
    for j in range(DEPTH, -1, -1):
        here = open_.withColumn("short", F.col("key").bitwiseAND(mask(j + 1))).withColumn("context", F.shiftright("short", 8))
        here = here.join(seen[j].select(F.col("key").alias("short"), "n"), "short", "left").join(contexts[j], "context", "left")
        left_n, left_kinds = F.col("total") - F.col("gone"), F.col("kinds") - F.col("gone_kinds")
        here = written(here.withColumn("room", left_n + left_kinds).withColumn("left_kinds", left_kinds))
        done.append(here.where("n IS NOT NULL").select("key", (F.col("lp") + F.log10(F.col("n") / F.col("room"))).alias("lp")))
        escape = F.when(F.col("room") > 0, F.log10(F.col("left_kinds") / F.col("room"))).otherwise(0.0)
        open_ = here.where("n IS NULL").select("key", (F.col("lp") + escape).alias("lp"), F.coalesce("excluded", "gone").alias("gone"), F.coalesce("kinds", "gone_kinds").alias("gone_kinds"))
    done.append(open_.select("key", (F.col("lp") - F.log10(256 - F.col("gone_kinds"))).alias("lp")))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    rows = split_rows(docs, doc_id, text, folds, held_out)
    asked = written(windows(rows))
    words = written(asked.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("c")))
    total = words.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    tokens, kinds = total["n"] or 0, total["v"] or 0
    lp = gram_scores(written(asked.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n"))))
    answers = packed(asked.where("key IS NOT NULL").select("block", "key").join(lp, "key")).withColumn("words", F.lit(None).cast("binary"))
    answers = answers.unionByName(packed_words(asked.where("word IS NOT NULL").select("block", "word").join(words, "word")), allowMissingColumns=True)
    kind = docs.schema[doc_id].dataType.simpleString()

    def add_up(texts, found):
        import pyarrow as pa
        import pyarrow.compute as pc

        own = pc.is_valid(found.column("words"))
        key, values = unpacked(found.filter(pc.invert(own)))
        table = Lookup(key)
        count = {}
        for spelled, n, numbers in zip(*(found.filter(own).column(c).to_pylist() for c in ("words", "n", "numbers"))):
            count.update(zip(spelled.split(b" "), unsqueezed(numbers, n, np.int64).tolist()))
        base = {c: np.log10((c + 0.5) / (tokens + 0.5 * (kinds + 1))) for c in set(count.values())}
        end = END_WORD.encode()
        n_tokens, n_known, base_score, scores = [], [], [], [np.empty(0)]
        for run in chunks(t.lower() for t in encoded(texts.column("text"))):
            wanted, lengths = keys(run, DEPTH + 1)
            scores.append(by_text(values[table.at(wanted)], lengths))
            for t in run:
                seen = [count[w] for w in (*t.split(), end)]
                n_tokens.append(len(seen))
                n_known.append(sum(c > 0 for c in seen))
                base_score.append(float(sum(map(base.__getitem__, seen))))
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "base_score": pa.array(base_score, pa.float64()),
                "score": pa.array(np.concatenate(scores), pa.float64(), from_pandas=True),
            }
        )

    texts = rows.select("block", F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text")
    found = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.select(F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
