"""Phrase mining against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from slatecraft.llm import phrases

DOCS = "doc_id long, text string, lang string, phrase string, n long, block string"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def plain(rows, least, inside=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        longer = Counter()
        for p, a in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        kept = []
        for p, a in often.items():
            if 100 * longer[p] >= inside * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def mined(spark, rows, **how):
    frame = spark.createDataFrame([(i, t, g, "x", 7, "y") for i, (t, g) in enumerate(rows)], DOCS)
    return sorted(map(tuple, phrases.collocations(frame, **how).collect()))


def made_up(rng, words, vocabulary):
    gap = lambda: rng.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", " \x0c", "\r\n", "!?"])
    return "".join(rng.choice(vocabulary) + gap() for _ in range(words))


def test_counts_scores_and_order(spark):
    rng = random.Random(1)
    vocabulary = ["the", "The", "of", "ÄÖ", "äö", "x-y", "\x01", "naïve", "日本", "a", "b", "c"]
    rows = [(made_up(rng, rng.randint(0, 300), vocabulary), rng.choice(["en", "de", None, "und", ""])) for _ in range(60)]
    rows += [(None, "en"), ("", None), (" \t\n.", "en"), ("only", "rare"), *[("same text the of the of", "en")] * 50]
    rows += [(" lead. the of , trail ", "en"), ("\n\n", "de")]
    found = mined(spark, rows, least=12)
    assert found == plain(rows, 12) and {r[0] for r in found} == {"en", "de", "und", ""}
    assert mined(spark, rows, least=12, top=3) == plain(rows, 12, top=3)


def test_empty_table(spark):
    assert mined(spark, [], least=2) == []


def test_very_long_text_without_marks(spark):
    rng = random.Random(2)
    words = [rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str(rng.randint(0, 9)) for _ in range(1_500_000)]
    rows = [(" ".join(words), "en"), (" ".join(words[:1000]), "en")]
    assert len(rows[0][0]) > 3 * phrases.BLOCK
    found = mined(spark, rows, least=250)
    assert found and found == plain(rows, 250)


def test_cut_parts_hold_every_run_once(monkeypatch):
    rng = random.Random(3)
    for block in (40, 200, 1000):
        monkeypatch.setattr(phrases, "BLOCK", block)
        for text in (made_up(rng, 3000, ["a", "bb", "ccc"]), "aa bb " * 800, "w" * 5000, "w" * 500 + " x " + "y" * 3000 + " z. q", "a b c d " + "e" * 900 + " f g" * 90):
            whole = phrases.normalise(np.frombuffer(text.encode(), np.uint8))
            got = Counter()
            for part, carried in phrases._cut(whole):
                first, last = phrases.runs(part, carried)
                got.update(bytes(part[a:b]).decode() for a, b in zip(first, last))
            want = Counter(" ".join(w[i : i + n]) for w in pieces(text) for n in range(1, 5) for i in range(len(w) - n + 1))
            assert got == want


def test_equal_fingerprints_are_told_apart(spark, monkeypatch):
    """With fingerprints of two bits only the text decides."""
    mixed = phrases._mixed
    monkeypatch.setattr(phrases, "_mixed", lambda x: mixed(x) & np.uint64(3 << 62))
    rng = random.Random(4)
    rows = [(made_up(rng, 80, ["a", "b", "c", "d"]), "en") for _ in range(20)]
    assert mined(spark, rows, least=10) == plain(rows, 10)


def test_fingerprints_do_not_depend_on_place():
    text = np.frombuffer(b"one two\nthree one two one\n", np.uint8)
    first, last = phrases.runs(text, 0)
    prints = phrases.fingerprints(text, first, last, "en")
    by_text = defaultdict(set)
    for a, b, p in zip(first, last, prints):
        by_text[bytes(text[a:b])].add(int(p))
    assert all(len(p) == 1 for p in by_text.values()) and len({min(p) for p in by_text.values()}) == len(by_text)
    assert not set(map(int, prints)) & set(map(int, phrases.fingerprints(text, first, last, "de")))
