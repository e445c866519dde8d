"""Phrase collocations: Rabin-Karp fingerprints of every run of one to four words, counted by shuffles.

Texts become blocks of a few MB, one language each: words with one space between them, pieces with a line feed
between them, written once. Over a block, numpy prefix polynomials (a random 64-bit value for each byte, mod
2^64) give the fingerprint of every run of words by one subtraction and one product. A block sends each of its
distinct fingerprints with its count to a shard, as sorted binary columns; shards are ranges of fingerprints,
about ``SHARD`` of them each. The occurrence pointer of a fingerprint is its block and its place in the block's
sorted list, so it takes no bytes: a shard adds up the counts and answers each block with one bit for each
fingerprint it sent, set where the sum reaches the least count. The block then reads those runs off its text
and sends them as text. These are counted again, by text, so two runs with one fingerprint are told apart;
only runs that may be frequent are ever made text. The sum over a fingerprint is never below a run's own
count, hence none is missed.

A word that every text holds is one fingerprint a block, so no shard grows with its frequency. All steps pass on
amounts that grow in proportion to the input; nothing is broadcast by this module or goes through the driver but
one count. Blocks are written, hence the same for every later step, also after a lost executor.

Defined cases: null texts hold no words, a null language is ``und``. Repeated rows count each. A text without
marks longer than a block is cut at a space, its last three words repeated in the next block without being
counted twice. A single text is one Arrow row, and a task needs about ten times its bytes. Ties of score and count
go by the phrase's bytes. Empty tables and languages without frequent phrases give no rows. Other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.llm.frames import whole_text, written

#: Words of the longest phrase.
LONGEST = 4
#: Bytes of a block of normalised text, about.
BLOCK = 3_000_000
#: Distinct fingerprints, summed over blocks, that a shard gets, about.
SHARD = 3_000_000
_SPACE, _MARK = 32, 10

# what a byte becomes: A-Z in lower case, blanks a space, the marks that end a piece a line feed
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[9] = _SPACE
_BYTES[[ord(c) for c in ".,;:!?\n\v\f\r"]] = _MARK

BLOCKS = "block string, lang string, words long, carried int, text binary"


def normalise(raw: np.ndarray) -> np.ndarray:
    """Lower-cased words with one space between them and one line feed after each piece; no empty words or pieces."""
    out = np.append(_BYTES[raw], np.uint8(_MARK))
    gap = (out == _SPACE) | (out == _MARK)
    starts = np.flatnonzero(gap & np.append(True, ~gap[:-1]))
    # a run of gaps is a line feed if it holds one; it stands at the start of the run
    marks = np.maximum.reduceat((out == _MARK), starts)
    out[starts] = np.where(marks, _MARK, _SPACE).astype(np.uint8)
    kept = ~gap
    kept[starts[1:] if starts[0] == 0 else starts] = True
    return out[kept]


def _cut(text: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of about a block, with how many of a part's first words the part before counted."""
    start, carried = 0, 0
    while len(text) - start > 2 * BLOCK:
        part = text[start : start + BLOCK]
        marks = np.flatnonzero(part[BLOCK // 2 :] == _MARK)
        gaps = np.flatnonzero(part == _SPACE)
        if len(marks):
            end, back, next_ = start + BLOCK // 2 + int(marks[-1]) + 1, 0, 0
        elif len(gaps) > LONGEST and gaps[-LONGEST] > BLOCK // 2:
            end = start + int(gaps[-1]) + 1
            back, next_ = end - (start + int(gaps[-LONGEST]) + 1), LONGEST - 1
        else:  # words of half a block and more: to the end of the piece, however far
            rest = np.flatnonzero(text[start + BLOCK :] == _MARK)
            end, back, next_ = start + BLOCK + int(rest[0]) + 1, 0, 0
        part = text[start:end].copy()
        part[-1] = _MARK
        yield part, carried
        start, carried = end - back, next_
    if start < len(text):
        yield text[start:], carried


def _word_count(text: np.ndarray) -> int:
    return int(np.count_nonzero((text == _SPACE) | (text == _MARK)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), 0
    open_: dict[str, list[np.ndarray]] = {}
    held: dict[str, int] = {}

    def row(lang: str, parts: list[np.ndarray], carried: int) -> pa.RecordBatch:
        nonlocal made
        made += 1
        text = np.concatenate(parts)
        values = [[f"{task}-{made}"], [lang], [_word_count(text) - carried], [carried], [text.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _BLOCK_TYPES)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    for batch in batches:
        texts, langs = batch.column(0), batch.column(1)
        for i in range(len(texts)):
            raw = texts[i].as_buffer()
            if raw is None or raw.size == 0:
                continue
            lang = langs[i].as_py()
            text = normalise(np.frombuffer(raw, np.uint8))
            for part, carried in _cut(text):
                if carried or len(part) >= BLOCK:
                    yield row(lang, [part], carried)
                    continue
                open_.setdefault(lang, []).append(part)
                held[lang] = held.get(lang, 0) + len(part)
                if held[lang] >= BLOCK:
                    yield row(lang, open_.pop(lang), 0)
                    held.pop(lang)
                elif len(open_) > 8 and sum(held.values()) > 4 * BLOCK:
                    most = max(held, key=held.get)
                    yield row(most, open_.pop(most), 0)
                    held.pop(most)
    for lang, parts in open_.items():
        yield row(lang, parts, 0)


_BLOCK_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary()]


def blocks(docs: DataFrame) -> DataFrame:
    """The normalised text of all documents in written blocks."""
    texts = docs.select(whole_text().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return written(texts.mapInArrow(_blocks, BLOCKS))


# fingerprints

_RANDOM = np.random.default_rng(20_121)
_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses
#: 48 bits are sent: as the text decides, a shared fingerprint costs a needless run of text and no more.
_KEPT = np.uint64(0xFFFFFFFFFFFF0000)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    done = 1
    while done <= n:  # doubling: the next stretch is this one times a power
        more = min(done, n + 1 - done)
        out[done : done + more] = out[:more] * (out[done - 1 : done] * base)
        done += more
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit depends on all others, so that the top ones can deal fingerprints out."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(text: np.ndarray, carried: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of every run of one to ``LONGEST`` words within a piece, as int32."""
    ends = np.flatnonzero((text == _SPACE) | (text == _MARK)).astype(np.int32)
    starts = np.append(np.int32(0), ends[:-1] + 1).astype(np.int32)
    # words of one piece share a number
    piece = np.append(0, np.cumsum(text[ends[:-1]] == _MARK)) if len(ends) else np.zeros(0, np.int64)
    first, last = [], []
    for n in range(1, LONGEST + 1):
        m = len(ends) - n + 1
        if m <= 0:
            break
        same = piece[:m] == piece[n - 1 :]
        same[: max(0, carried - n + 1)] = False  # those that end within the carried words
        first.append(starts[:m][same])
        last.append(ends[n - 1 :][same])
    if not first:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(first), np.concatenate(last)


def fingerprints(text: np.ndarray, first: np.ndarray, last: np.ndarray, lang: str) -> np.ndarray:
    prefix = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_VALUE[text] * _powers(_BASE, len(text))[:-1], out=prefix[1:])
    found = prefix[last] - prefix[first]
    del prefix
    found *= _powers(_INVERSE, len(text))[first]
    salt = np.frombuffer(lang.encode(), np.uint8)
    own = (_VALUE[salt] * _powers(_BASE, len(salt))[:-1]).sum(keepdims=True)
    return _mixed(found ^ _mixed(own + np.uint64(1))) & _KEPT


def _shard_of(prints: np.ndarray, shards: int) -> np.ndarray:
    return ((prints >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _planes(values: np.ndarray) -> bytes:
    """Byte by byte, highest first: the sorted high bytes hardly differ and compress to nothing."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def _slices(distinct: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards that a block sends to, and where its list is cut for them."""
    of = _shard_of(distinct, shards)
    cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    return of[cuts].astype(np.int64), np.append(cuts, len(of))


SENT = "shard long, block string, prints binary, counts binary"


def _send(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, lang, carried, text = (batch.column(i)[row].as_py() for i in range(4))
                raw = np.frombuffer(text, np.uint8)
                first, last = runs(raw, carried)
                prints = fingerprints(raw, first, last, lang)
                prints.sort()
                cut = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.zeros(0, np.int64)
                counts = np.diff(np.append(cut, len(prints)))
                distinct = prints[cut]
                of, cuts = _slices(distinct, shards)
                pairs = list(zip(cuts[:-1], cuts[1:]))
                for lo in range(0, len(pairs), 256):
                    part = pairs[lo : lo + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(of[lo : lo + 256]),
                            pa.array([block] * len(part), pa.string()),
                            pa.array([_planes(distinct[a:b]) for a, b in part], pa.binary()),
                            pa.array([_planes(counts[a:b]) for a, b in part], pa.binary()),
                        ],
                        names=["shard", "block", "prints", "counts"],
                    )

    return send


def _answer(least: int):
    def answer(table: pa.Table) -> pa.Table:
        """For each block that sent to this shard, one bit for each of its fingerprints: may be frequent."""
        sent = [_from_planes(x.as_py()) for x in table["prints"]]
        counts = np.concatenate([_from_planes(x.as_py()) for x in table["counts"]]).astype(np.int64)
        every = np.concatenate(sent)
        order = np.argsort(every)
        ranked = every[order]
        cut = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        often = np.add.reduceat(counts[order], cut) >= least
        flags = np.empty(len(every), bool)
        flags[order] = np.repeat(often, np.diff(np.append(cut, len(every))))
        at = np.cumsum([0, *map(len, sent)])
        bits = [np.packbits(flags[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
        return pa.table({"block": table["block"].combine_chunks(), "shard": table["shard"].combine_chunks(), "bits": pa.array(bits, pa.binary())})

    return answer


COUNTED = "lang string, phrase string, n long"


def _texts_of(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The text of each run, cut out of the block."""
    sizes = (last - first).astype(np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    from_ = np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(raw[from_].tobytes()))


def _read_off(shards: int):
    def read_off(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        """The runs of a block that may be frequent, as text, with their counts in the block."""
        made = []
        if blocks.num_rows and answers.num_rows:
            raw = np.frombuffer(blocks["text"][0].as_py(), np.uint8)
            lang = blocks["lang"][0].as_py()
            first, last = runs(raw, blocks["carried"][0].as_py())
            prints = fingerprints(raw, first, last, lang)
            distinct, place = np.unique(prints, return_inverse=True)
            del prints
            of, cuts = _slices(distinct, shards)
            bits = dict(zip(answers["shard"].to_pylist(), answers["bits"].to_pylist()))
            flags = np.concatenate([np.unpackbits(np.frombuffer(bits[s], np.uint8), count=b - a) for s, a, b in zip(of.tolist(), cuts[:-1], cuts[1:])]).astype(bool)
            chosen = flags[place]
            first, last = first[chosen], last[chosen]
            step = 250_000
            for lo in range(0, len(first), step):
                found = _texts_of(raw, first[lo : lo + step], last[lo : lo + step]).value_counts()
                made.append(pa.table({"lang": pa.array([lang] * len(found), pa.string()), "phrase": found.field("values").cast(pa.string()), "n": found.field("counts").cast(pa.int64())}))
        return pa.concat_tables(made) if made else pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "n": pa.array([], pa.int64())})

    return read_off


def frequent(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Runs of one to four words with at least so many occurrences (lang, phrase, n), and words by lang."""
    parts = blocks(docs)
    words = parts.groupBy("lang").agg(F.sum("words").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(LONGEST * total / SHARD))
    sent = parts.select("block", "lang", "carried", "text").mapInArrow(_send(shards), SENT)
    answers = sent.groupBy("shard").applyInArrow(_answer(least), "block string, shard long, bits binary")
    counted = (
        parts.select("block", "lang", "carried", "text")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_read_off(shards), COUNTED)
        .groupBy("lang", "phrase")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )
    return written(counted), words


def collocations(docs: DataFrame, least: int = 30, inside: int = 80, top: int = 2000) -> DataFrame:
    """The best ``top`` phrases of two to four words of each language, by their weakest cut.

    A phrase with count a, cut into parts with counts l and r, scores floor(2000000 a / (l + r)). A phrase goes
    if a longer frequent one holds it and has at least ``inside`` percent of its count.
    """
    counts, words = frequent(docs, least)
    phrases = counts.withColumn("words_", F.split("phrase", " ")).where(F.size("words_") >= 2)
    exact = lambda c: F.col(c).cast("decimal(20,0)")

    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "words_", F.explode(F.sequence(F.lit(1), F.size("words_") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words_", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words_", F.col("k") + 1, F.size("words_") - F.col("k")), " ").alias("right"),
    )
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    whole = (F.lit(2_000_000).cast("decimal(7,0)") * exact("a"))
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn("score", F.call_function("div", whole, exact("l") + exact("r")))
    weakest = F.min(F.struct("score", "k", "l", "r"))
    scored = scored.groupBy("lang", "phrase", "a").agg(weakest.alias("cut"))

    size = F.size("words_")
    spans = F.flatten(
        F.transform(F.sequence(F.lit(1), size - 1), lambda s: F.transform(F.filter(F.sequence(F.lit(2), size - 1), lambda n: s + n - 1 <= size), lambda n: F.array_join(F.slice("words_", s, n), " ")))
    )
    holders = (
        phrases.where(size >= 3)
        .select("lang", "n", F.explode(spans).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    stays = F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * inside)
    kept = scored.join(holders, ["lang", "phrase"], "left").where(stays).select("lang", "phrase", "a", "cut.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of a language are among the first of its parts, so none of its tasks sees all its phrases
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    ahead = kept.withColumn("at", F.row_number().over(parts)).where(F.col("at") <= top).drop("at")
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
