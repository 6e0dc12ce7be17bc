import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from despensa.llm import linededup, simhash


def brute_lines(rows, size=3):
    """Cleaned texts by the definition, over distinct (id, text) in order."""
    key = lambda r: (r[0] is not None, r[0] or 0)
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=key):
        if t is None:
            out[d, t] = None
            continue
        lines = t.split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for i in range(len(at) - size + 1):
            w = tuple(lines[j].strip(" \t\r") for j in at[i:i + size])
            if w in seen:
                gone |= set(range(at[i], at[i + size - 1] + 1))
            seen.add(w)
        out[d, t] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_windows_as_brute_force(docs_of):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", " a ", "b", "c", "", "\t", "d"]) for _ in range(rng.randint(0, 12))))
            for i in range(150)]
    rows += [(500, None), (501, ""), (502, "a\na\na\na\na"), (503, "one line")]
    want = brute_lines(rows)
    docs = docs_of(rows)
    got = linededup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "lines_removed"]
    told = {r["doc_id"]: r for r in got.collect()}
    assert len(told) == len(rows)
    for d, t in rows:
        assert told[d]["text"] == want[d, t], (d, t)
        if t is not None and told[d]["lines_removed"] == 0:
            assert told[d]["text"] == t


def test_line_windows_odd_rows(docs_of, odd_rows):
    got = linededup.dedup_lines(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    want = Counter((d, brute_lines(odd_rows)[d, t]) for d, t in odd_rows)
    assert Counter((r["doc_id"], r["text"]) for r in got) == want
    assert linededup.dedup_lines(docs_of([])).count() == 0


def test_first_occurrence_of_every_line_stays(docs_of):
    rng = random.Random(4)
    rows = [(i, "\n".join(str(rng.randint(0, 9)) for _ in range(10))) for i in range(100)]
    got = linededup.dedup_lines(docs_of(rows)).collect()
    assert {x for r in got for x in r["text"].split("\n")} >= {x for _, t in rows for x in t.split("\n")}


def test_result_takes_the_place_of_a_clashing_column(docs_of):
    docs = docs_of([(1, "a\nb\nc\na\nb\nc")]).withColumn("lines_removed", F.lit("old"))
    row = linededup.dedup_lines(docs).first()
    assert row["lines_removed"] == 3 and row["text"] == "a\nb\nc"


def brute_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def brute_components(fps, radius):
    """Component of each distinct fingerprint, by comparing all pairs."""
    fps = np.array(sorted(set(fps)), np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {int(f): find(i) for i, f in enumerate(fps)}


def test_fingerprints(docs_of, odd_rows):
    rows = odd_rows + [(20 + i, " ".join(["Foo\x0bBAR", "é", "b", "c", "d"][:i])) for i in range(6)]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter(
        (d, f"{brute_fingerprint(t):016x}") for d, t in rows)
    blank = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in blank} == {2}


@pytest.mark.parametrize("radius", [0, 1, 4])
def test_masks_cover(radius):
    """Any difference of at most ``radius`` bits is outside of some mask, in every round."""
    rng = random.Random(radius)
    for round_ in range(3):
        m = simhash.masks(radius, round_)
        assert len(m) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            x = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(x & k == 0 for k in m)


@pytest.mark.parametrize("limit", [4096, 24])
def test_links_join_all_within_the_radius(spark, limit):
    """Chains and dense groups; a small limit sends groups through further rounds of masks."""
    rng = random.Random(9)
    fps = set()
    for _ in range(6):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
    fps |= {rng.getrandbits(64) for _ in range(50)}
    base = rng.getrandbits(64)
    fps |= {base ^ (1 << a) ^ (1 << b) for a in range(0, 10) for b in range(10, 14)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long").repartition(4)
    comp = simhash.components(simhash.near_links(df, 4, limit)).collect()
    root = {r["node"] % 2**64: r["root"] % 2**64 for r in comp}
    want = brute_components(fps, 4)
    groups = Counter(want.values())
    for f in fps:
        assert (f in root) == (groups[want[f]] > 1 and f != min(
            (x for x in fps if want[x] == want[f]), key=simhash.signed)), hex(f)
    for a in fps:
        for b in fps:
            assert (want[a] == want[b]) == (root.get(a, a) == root.get(b, b))


def test_groups_across_batches():
    """Rows of a key may come in many small batches; large groups are handed on whole."""
    import pyarrow as pa

    rng = random.Random(2)
    rows = sorted((t, k, rng.getrandbits(64)) for t in range(3) for k in range(5) for _ in range(rng.randint(1, 9)))
    sizes = Counter((t, k) for t, k, _ in rows)

    def batches(n):
        for i in range(0, len(rows), n):
            t, k, f = zip(*rows[i:i + n])
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(k), pa.array(np.array(f, np.uint64).view(np.int64))],
                                             names=["t", "k", "fp"])

    for n in (1, 2, 7, 1000):
        out = [r for b in simhash.compare_sorted(64, 4)(batches(n)) for r in b.to_pylist()]
        handed = Counter((r["t"], r["k"]) for r in out if r["t"] >= 0)
        assert handed == Counter({g: c for g, c in sizes.items() if c > 4}), n
        assert sum(r["t"] < 0 for r in out) == sum(c - 1 for c in sizes.values() if c <= 4)


def test_near_duplicates_chain(docs_of):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(9, text), (3, text.replace("w77 ", "w77x ")), (5, text), (8, "something else altogether here")]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs_of(rows)).collect()}
    assert got[8] == 8 and got[5] == got[9]
    kept = simhash.keep_one(docs_of(rows))
    assert {r["doc_id"] for r in kept.collect()} == set(got.values()) and kept.columns == docs_of(rows).columns
    assert simhash.keep_one(docs_of([])).count() == 0
