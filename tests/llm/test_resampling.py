"""Importance resampling against plain counting of every feature."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from slatecraft.llm import resampling

DOCS = "doc_id long, text string, Score string, place_ long, n_words string"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets_of(text):
    words = words_of(text)
    return Counter(zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1))


def plain(docs, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s += buckets_of(text)
    for text in target:
        t += buckets_of(text)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for doc_id, text in docs:
        own = buckets_of(text)
        weight = sum(gain(b) * n for b, n in own.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, sum(own.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))])
    long_ = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = long_[: percent * len(long_) // 100]
    ranks = {id(r): i for i, r in enumerate(drawn, 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=repr)


def resampled(spark, docs, target, **how):
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS)
    found = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert "place_" in found.columns
    return sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def made_up(rng, words):
    vocabulary = ["The", "of", "İx", "naïve", "日本", "a1", "z", "B", "word" * 12, "é" * 70]
    gaps = [" "] * 8 + ["\n", "\n\n", ". ", "-", "\t", " \n ", "\r\n"]
    return "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(words))


def test_features_weights_and_draw(spark):
    rng = random.Random(1)
    docs = [(i, made_up(rng, rng.randint(0, 60))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "\n\n"), (503, "one"), (504, "one\ntwo"), (505, "one\ntwo\nthree four\n\nfive"), (None, made_up(rng, 40))]
    docs += [(600 + i, "same line of text\n" * 30) for i in range(40)] + [(700, "twice " * 25)] * 2 + [(None, "no id " * 30)] * 2
    target = [made_up(rng, 30) for _ in range(10)] + [None, "", "same line of text"]
    assert resampled(spark, docs, target) == plain(docs, target)
    assert resampled(spark, docs, target, percent=50, least_words=3) == plain(docs, target, 50, 3)


def test_empty_tables(spark):
    assert resampled(spark, [], ["x"]) == []
    docs = [(1, "a b c " * 20), (2, "b")]
    assert resampled(spark, docs, [], percent=100) == plain(docs, [], 100)


def test_very_long_text(spark):
    rng = random.Random(2)
    long_ = made_up(rng, 900_000)
    assert len(words_of(long_)) > resampling.CHUNK and len(long_) > resampling.BATCH
    docs = [(1, long_), (2, "w" * 3_000_000), (3, long_[:500])]
    assert resampled(spark, docs, ["日本 of the"], percent=100) == plain(docs, ["日本 of the"], 100)


def test_chunks_and_neighbouring_texts(monkeypatch):
    """Words that touch at the border of two texts stay apart, whatever the size of a chunk."""
    rng = random.Random(3)
    texts = ["ab", "cd", "", "ef gh", "\n", "ij\nkl mn", "A", *[made_up(rng, 20) for _ in range(30)]]
    want = sum((buckets_of(t) for t in texts), Counter())
    for chunk in (1, 2, 7, 1000):
        monkeypatch.setattr(resampling, "CHUNK", chunk)
        words = resampling.Words(pa.array(texts))
        got = Counter()
        for across in (False, True):
            for _, bucket in words.features(across):
                got.update(bucket.tolist())
        assert got == want


def test_counts_by_distinct_lines(spark):
    texts = ["a b\nc d e\n\nf", "a b\nc d e", "a b", None, "a b\n" * 1000]
    found = dict(resampling.feature_counts(spark.createDataFrame([(t,) for t in texts], "text string")).collect())
    assert found == dict(sum((buckets_of(t) for t in texts), Counter()))
