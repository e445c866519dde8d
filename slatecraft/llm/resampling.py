"""Importance resampling towards a target: hashed runs of one to three words, Gumbel top-k.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. A feature is a run of one to
three consecutive words of a text joined by one space; its bucket is the CRC-32 of its bytes modulo ``BUCKETS``.
A bucket's gain is the scaled log ratio of its smoothed share in the target to that in the corpus. A document's
weight is the sum of the gains of its features; its score adds Gumbel noise taken from its id.

Corpus counts come by segments: line feeds cut texts into lines, equal lines become one row with a number of
occurrences (an aggregate with map-side combine, so a line that a third of all texts hold is a few rows), the features
inside a distinct line are counted once and multiplied, and the features that reach over a line feed are counted from
the texts. Each task adds into one vector of ``BUCKETS`` counts. Weights need no shuffle: the gains, a vector of
fixed size, go to every task, which works each distinct line of a batch out once.

CRCs are taken for all words of a chunk at once, byte by byte; a run goes on from the state of the run that is
one word shorter. Chunks of ``CHUNK`` words bound the memory, so a very long text takes about ten times its bytes and
no more.

Defined cases: null and empty texts have no features and weight 0. Repeated rows count each and get one score;
which of several equal rows is drawn makes no difference. Null ids are written as an empty text in the noise and come
last among ties. An empty table gives no rows; an empty target gains by its smoothing alone. Other columns stay;
a column called like one of the output is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecraft.llm.frames import unused, whole_text, written
from slatecraft.operators.ranking import add_row_number

BUCKETS = 10_000
#: Words of the longest feature.
LONGEST = 3
#: Words whose CRCs are taken at once.
CHUNK = 500_000
#: Text of rows that are worked on together, in bytes.
BATCH = 4_000_000
#: Bytes of a word that all words take together; the rest of longer ones is taken one by one.
_TOGETHER = 40
_FEED, _SPACE, _ONES = 10, 32, np.uint32(0xFFFFFFFF)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


class Words:
    """The words of some texts that lie in one buffer, one behind the other: where, how long, of which text and line."""

    def __init__(self, texts: pa.Array):
        offsets, raw = _bytes_of(texts)
        self.raw = _LOWER[raw]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = _IN_WORD[raw]
        change = np.flatnonzero(np.diff(inside))
        begin, end = change[::2], change[1::2]
        # a word that ends one text and one that starts the next are not the same
        borders = offsets[1:-1]
        cut = borders[(borders > 0) & (borders < len(raw))]
        cut = np.unique(cut[inside[cut] & inside[cut + 1] > 0]) if len(cut) else cut
        self.start = np.sort(np.concatenate([begin, cut]))
        self.size = np.sort(np.concatenate([end, cut])) - self.start
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.line = np.searchsorted(np.flatnonzero(raw == _FEED), self.start)

    def __len__(self) -> int:
        return len(self.start)

    def _feed(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """CRC states after the bytes of the words."""
        size = self.size[word]
        left = (_TOGETHER - np.minimum(size, _TOGETHER)).astype(np.uint8)
        order = np.argsort(left, kind="stable")
        state, at, size, left = state[order], self.start[word][order], size[order], left[order]
        # longest first: the first n words still have a byte p
        for p, n in enumerate(np.searchsorted(left, np.arange(_TOGETHER - 1, -1, -1), side="right")):
            if n == 0:
                break
            part = state[:n]
            state[:n] = _CRC[(part ^ self.raw[at[:n] + p]) & 255] ^ (part >> 8)
        for i in np.flatnonzero(size > _TOGETHER):
            rest = self.raw[at[i] + _TOGETHER : at[i] + size[i]]
            state[i] = zlib.crc32(rest, int(state[i] ^ _ONES)) ^ 0xFFFFFFFF
        out = np.empty_like(state)
        out[order] = state
        return out

    def features(self, across: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First word and bucket of each feature: those inside a line, or those that reach over a line feed."""
        n = len(self)
        for lo in range(0, n, CHUNK):
            word = np.arange(lo, min(n, lo + CHUNK))
            state = np.full(len(word), _ONES, np.uint32)
            chosen = []
            for more in range(LONGEST):
                last = np.minimum(word + more, n - 1)
                whole = (word + more < n) & (self.text[last] == self.text[word])
                chosen.append(whole & ((self.line[last] != self.line[word]) == across))
            for more in range(LONGEST):
                needed = np.logical_or.reduce(chosen[more:])
                word, state = word[needed], state[needed]
                chosen = [c[needed] for c in chosen]
                if more:
                    state = _CRC[(state ^ _SPACE) & 255] ^ (state >> 8)
                state = self._feed(state, word + more)
                mine = chosen[more]
                yield word[mine], (state[mine] ^ _ONES) % BUCKETS


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, from zero, and bytes of an array without nulls."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``BATCH`` bytes, one row at least."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > BATCH:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _sums(across: bool):
    """Counts by bucket of a task's rows (text, occurrences)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts, times = batch.column(0), batch.column(1).to_numpy()
            for a, b in _pieces(texts):
                words = Words(texts[a:b])
                for word, bucket in words.features(across):
                    np.add.at(total, bucket, times[a:b][words.text[word]])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    return sums


def feature_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Features of all texts by bucket (bucket, n), by distinct lines and what reaches over their ends."""
    whole = texts.select(whole_text(text).alias("text"))
    lines = whole.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line") != "").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    inside = lines.mapInArrow(_sums(across=False), "bucket int, n long")
    over = whole.where(F.contains("text", F.lit("\n"))).withColumn("times", F.lit(1).cast("long")).mapInArrow(_sums(across=True), "bucket int, n long")
    return inside.unionByName(over).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> list[int]:
    """The gain of every bucket: ``BUCKETS`` numbers, whatever the size of the tables."""
    both = feature_counts(docs).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    both = both.unionByName(feature_counts(target).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    found = {r["bucket"]: (r["s"], r["t"]) for r in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()}
    all_s, all_t = sum(s for s, _ in found.values()), sum(t for _, t in found.values())
    smoothed = np.array([found.get(b, (0, 0)) for b in range(BUCKETS)], float) + 1
    ratio = (smoothed[:, 1] * (all_s + BUCKETS)) / (smoothed[:, 0] * (all_t + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def _weigh(at: int, gained: list[int]):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = np.array(gained, float)  # whole numbers; their sums are exact far beyond any text

        def summed(words: Words, across: bool, rows: int) -> np.ndarray:
            """Words, features and gains of each text."""
            out = np.zeros((3, rows))
            for word, bucket in words.features(across):
                text = words.text[word]
                out[1] += np.bincount(text, minlength=rows)
                out[2] += np.bincount(text, worth[bucket], rows)
            if not across:
                out[0] = np.bincount(words.text, minlength=rows)
            return out

        for batch in batches:
            texts = batch.column(at).cast(pa.large_string()).fill_null("")
            for a, b in _pieces(texts):
                part = texts[a:b]
                split = pc.split_pattern(part, "\n")
                coded = split.flatten().dictionary_encode()
                of_line = summed(Words(coded.dictionary), False, len(coded.dictionary))[:, coded.indices.to_numpy()]
                row = pc.list_parent_indices(split).to_numpy()
                made = summed(Words(part), True, b - a)
                for k in range(3):
                    made[k] += np.bincount(row, of_line[k], b - a)
                more = [pa.array(made[k].astype(np.int64)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns], *more], names=[str(i) for i in range(batch.num_columns + 3)])

    return weigh


def weigh(docs: DataFrame, gained: list[int], text: str = "text") -> DataFrame:
    """The rows with ``n_words``, ``n_features`` and ``weight``, in one pass."""
    kept = docs.select(*[c for c in docs.columns if c.lower() not in ("n_words", "n_features", "weight")])
    added = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    return kept.mapInArrow(_weigh(kept.columns.index(text), gained), T.StructType([*kept.schema.fields, *added]))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((number + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, keep: Sequence[str] | None = None
) -> DataFrame:
    """All rows with ``n_features``, ``weight``, ``score`` and ``rank``, which is null for those not drawn.

    Rows are written and sorted by score with the columns named in ``keep``; by default that is all of them, texts
    included. Drawn are ``percent`` of the documents with at least ``least_words`` words, those with the highest scores, ties by
    the smaller doc_id.
    """
    weighed = weigh(docs, gains(docs, target))
    place, long_ = unused(weighed, "place_", "long_")
    kept = [c for c in (weighed.columns if keep is None else [*keep, "n_features", "weight"]) if c.lower() not in ("score", "rank", "n_words")]
    scored = written(
        weighed.select(*kept, (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), (F.col("n_words") >= least_words).alias(long_))
    )
    drawn = scored.agg(F.call_function("div", F.count_if(long_) * percent, F.lit(100))).scalar()
    numbered = add_row_number(scored, [F.desc(long_), F.desc("score"), F.asc_nulls_last("doc_id")], place)
    return numbered.withColumn("rank", F.when(F.col(place) <= drawn, F.col(place))).drop(place, long_)
