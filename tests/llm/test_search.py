import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from despensa.llm import decontaminate, topk


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(doc, items, size=10):
    d, hit, found = words(doc), set(), set()
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(d) - n + 1):
            if n and tuple(d[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(d), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    vocab = ["a", "B", "c'c", "dé", "E9", "the", "the", "the", "ñ"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 14)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "the"), (None, "B c'c")]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    for i in range(20):
        t = items[i][1].split(" ")
        docs.append((200 + i, "x y " + " , ".join(t) + " z"))
    docs += [(300, None), (301, ""), (302, "the " * 3000), (1, docs[1][1]), (None, "the end")]
    return docs, items


@pytest.mark.parametrize("slop", [0, 2])
def test_hits_as_brute_force(spark, docs_of, cases, slop):
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("text2", F.lit("z"))
    got = decontaminate.decontaminate(docs_of(docs), bench, slop=slop, every=slop > 0)
    told = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect()]
    want = [(d, *brute_hits(t, items)) for d, t in docs]
    want = [(*x, x[2] > 0) for x in want]
    assert sorted(told, key=repr) == sorted(want, key=repr)


def test_passes_give_the_same(spark, docs_of, cases, monkeypatch):
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = decontaminate.decontaminate(docs_of(docs), bench).collect()
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 7)
    many = decontaminate.decontaminate(docs_of(docs), bench).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_spans_are_the_covered_words(spark, docs_of, cases):
    """Merged, in order, apart, and the same words that every single match covers."""
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.decontaminate(docs_of(docs), bench, every=True).collect():
        within = {m["start"] + k for m in r["matches"] if m["exact"] for k in range(m["length"])}
        spans = [(s["start"], s["start"] + s["length"]) for s in r["spans"]]
        assert {k for a, b in spans for k in range(a, b)} == within and r["n_hit"] == len(within)
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_a_common_word_of_many_items_stays_small(spark, docs_of):
    """A word millions of times in a text, in 50 items: one span and 50 items, no list of pairs."""
    bench = spark.createDataFrame([(i, "word") for i in range(50)], "item_id long, text string")
    (r,) = decontaminate.decontaminate(docs_of([(1, "word " * 300_000)]), bench).collect()
    assert r["n_hit"] == r["n_words"] == 300_000 and len(r["items"]) == 50
    assert [tuple(s) for s in r["spans"]] == [(0, 300_000)]


def test_small_shards_and_long_documents(spark, docs_of, cases):
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(docs_of(docs, 1), shard_words=50)
    assert index.count() > 20
    n = decontaminate.search(index, bench).agg(F.sum("n_words")).first()[0]
    assert n == sum(len(words(t)) for _, t in docs)


def test_proximity(spark, docs_of):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = docs_of([(1, "x alpha beta gamma delta"), (2, "alpha big beta gamma delta"), (3, "delta gamma alpha"),
                    (4, "alpha alpha alpha alpha delta")])
    index = decontaminate.build_index(docs)
    got = {r["id"]: r["matches"] for r in decontaminate.search(index, bench, slop=1).collect()}
    assert [(m["start"], m["exact"]) for m in got[1]] == [(1, True)]
    assert [m["exact"] for m in got[2]] and not any(m["exact"] for m in got[2])
    assert got[3] == [] and got[4] == []


def test_empty_tables(spark, docs_of, cases):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.decontaminate(docs_of(cases[0]), none)
    assert got.count() == len(cases[0]) and got.filter("contaminated").count() == 0
    bench = spark.createDataFrame(cases[1], "item_id long, text string")
    assert decontaminate.decontaminate(docs_of([]), bench).count() == 0


def test_digest(spark, sf):
    from despensa.llm import queries

    row = queries.CONSULTAS["op8_positional_index"](spark, sf).filter("NOT contaminated").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()


def brute_top(rows, queries, k, scale=256.0):
    clean = [(i, np.floor(scale * np.array(v, float))) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in dict.fromkeys((i, tuple(v)) for i, v in queries if v and i is not None
                              and all(x is not None and np.isfinite(x) for x in v)):
        qv = np.floor(scale * np.array(v, float))
        some = sorted((-int(qv @ c), i) for i, c in clean if i != q and len(c) == len(qv))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(some)]
    return sorted(out)


@pytest.mark.parametrize("dims", [1, 16, 33])
def test_top_k_as_brute_force(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 1, dims) * (1 + 5 * (i % 7 == 0))])
            for i in range(400)]
    rows += [(500, None), (501, []), (502, [float("nan")] * dims), (503, [None] * dims), (None, rows[0][1]),
             (504, [float("inf")] * dims), (505, [0.5] * (dims + 1)), (506, [0.25] * (dims + 1)), (7, rows[7][1]),
             (600, rows[3][1]), (601, rows[3][1]), (602, [0.0] * dims)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    df = df.withColumn("score", F.lit(1))
    wanted = df.filter("vec_id % 10 = 0 OR vec_id > 499 OR vec_id IS NULL")
    got = sorted(tuple(r) for r in topk.top_k(df, wanted, 5).collect())
    assert got == brute_top(rows, [r for r in rows if r[0] is None or r[0] % 10 == 0 or r[0] > 499], 5)


def test_top_k_in_passes_and_of_nothing(spark, monkeypatch):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "PASS", 3)
    got = sorted(tuple(r) for r in topk.top_k(df, df.filter("vec_id < 20"), 4).collect())
    assert got == brute_top(rows, rows[:20], 4)
    assert topk.top_k(df.limit(0), df).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0
    assert topk.top_k(df.filter("vec_id = 1"), df.filter("vec_id = 1")).count() == 0
