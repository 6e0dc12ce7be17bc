import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from despensa.llm import phrases


def brute(rows, longest=3, at_least=10, first=2000, inside=50):
    """Collocations by their definition, over (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    often = {x: c for x, c in f.items() if c >= at_least}
    gone = set()
    for (lang, p), c in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * c >= inside * f[lang, p[i:i + k]]:
                    gone.add((lang, p[i:i + k]))
    by = defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) > 1 and (lang, p) not in gone:
            score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            by[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in by.items()
            for i, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1)}


def texts(seed, count, words):
    rng = random.Random(seed)
    spell = ["a", "B", "ç", "dé", "e-f", "日本", "g\x0bh", "i\tj", "k.", "l  m", "N"]
    pick = lambda: spell[min(int(rng.expovariate(0.4)), len(spell) - 1)]
    return [(rng.choice(["en", "fr", None]), " ".join(pick() for _ in range(rng.randint(0, words)))) for _ in range(count)]


def mined(docs_of, rows, **how):
    docs = docs_of([(i, t, lang) for i, (lang, t) in enumerate(rows)])
    return {tuple(r) for r in phrases.collocations(docs, **how).collect()}


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_as_brute_force_whatever_the_sample_proposes(docs_of, share):
    rows = texts(1, 120, 30)
    assert mined(docs_of, rows, share=share, at_least=5) == brute(rows, at_least=5)


def test_border_failures_are_expanded(docs_of, monkeypatch):
    """A phrase that no sampled text holds is found; without failures nothing more is counted."""
    rows = [("en", "rare three words here")] * 12 + [("en", "some other text")] * 3
    counted = {}
    count = phrases.spelled_counts

    def seen(*a):
        out = count(*a)
        counted[len(counted)] = {r["phrase"] for r in out.collect()}
        return out

    monkeypatch.setattr(phrases, "spelled_counts", seen)
    got = mined(docs_of, rows, share=0.0)
    assert got == brute(rows) and ("en", 1, "rare three words", 12, 12, 12, 57, 1000000) in got
    assert mined(docs_of, rows, share=1.0) == brute(rows)
    assert counted[0] == counted[1] and "other text" not in counted[1]


def test_full_filters_and_small_buffers_change_nothing(docs_of, monkeypatch):
    rows = texts(2, 80, 60)
    want = brute(rows, longest=4, at_least=4, first=15, inside=70)
    how = dict(longest=4, at_least=4, first=15, inside=70)
    monkeypatch.setattr(phrases, "BITS", (1 << 15, 1 << 28, 0))
    assert mined(docs_of, rows, **how) == want
    monkeypatch.setattr(phrases, "BYTES", 40)
    assert mined(docs_of, rows, **how) == want
    monkeypatch.setattr(phrases, "BYTES", 1)
    monkeypatch.setattr(phrases, "HELD", 100)
    assert mined(docs_of, rows, **how) == want


def test_more_words_than_packed_codes_hold():
    import numpy as np
    part = phrases.Part("en", b"", 3, True)
    part.words = [b""] * (1 << 22)
    part.ids = ids = np.random.default_rng(3).integers(1, 1 << 22, 4000).repeat(2)
    (a, b, c), n = part.distinct(np.arange(len(ids) - 2), 3)
    want = Counter(zip(ids, ids[1:], ids[2:]))
    assert {x: k for x, k in zip(zip(a, b, c), n)} == want


def test_odd_rows(docs_of, odd_rows):
    rows = [(r[2] if len(r) > 2 else "en", r[1]) for r in odd_rows]
    assert mined(docs_of, rows) == brute(rows)
    assert mined(docs_of, []) == set()
    assert mined(docs_of, [(None, None), ("en", "")]) == set()


def test_products_beyond_64_bits(spark):
    """Counts of the size that a corpus of 100 TB gives."""
    big = 9 * 10**12
    found = spark.createDataFrame(
        [("en", 0, "", 10 * big), ("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7)],
        "lang string, words int, phrase string, n long")
    keep = phrases.frequent_phrases
    try:
        phrases.frequent_phrases = lambda *a, **k: found
        (row,) = phrases.collocations(found.select(F.lit("x").alias("text"), "lang")).collect()
    finally:
        phrases.frequent_phrases = keep
    assert row["score"] == 1000000 * (big - 7) ** 2 // (big * (big - 1))
