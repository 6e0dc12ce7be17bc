"""SimHash near-dedup by covering locality-sensitive hashing.

Bits get random vectors over GF(2) with radius + 1 places. Every non-zero vector v of that space
names a table whose key keeps the bits whose vector is odd against v. The vectors of at most
``radius`` differing bits never span the space, so some v is even against all of them: every pair
within the radius shares its key in at least one of the 2^(radius+1) - 1 tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.llm.base import staged, text_map, unused

BITS = 64
SEED = 42
# Fingerprints with one key that a task compares directly; a larger group is cut by further masks.
GROUP = 4096


def fingerprint(text: str, shingle: int) -> int:
    """Bit-wise majority of the XXH64 hashes of the word shingles, ASCII lower-cased."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII white space and case
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    told = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(told[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i:i + 4096].byteswap().view(np.uint8)
        ones += np.unpackbits(part).reshape(-1, BITS).sum(0, dtype=np.int32)
    return int("".join("1" if n * 2 > len(hashes) else "0" for n in ones.tolist()), 2)


def masks(radius: int, round_: int) -> list[int]:
    """The covering masks; each round draws its own vectors."""
    rng = np.random.default_rng([SEED, radius, round_])
    width = radius + 1
    vectors = rng.integers(0, 1 << width, BITS)
    return [sum(1 << i for i, x in enumerate(vectors.tolist()) if (x & v).bit_count() & 1)
            for v in range(1, 1 << width)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(group: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, root) for each member of a component of more than one fingerprint.

    Every fingerprint is compared once with those not reached yet; so a dense group is cheap and
    a group of g never needs more than g * g / 2 comparisons nor more than its own memory.
    """
    if len(group) == 2:
        near = (int(group[0]) ^ int(group[1])).bit_count() <= radius
        return [(int(group[1]), int(group[0]))] if near else []
    out, left = [], group
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= radius
            if near.any():
                found = left[near]
                out += [(int(x), int(root)) for x in found]
                front += list(found)
                left = left[~near]
    return out


def compare_sorted(radius: int, limit: int):
    """Over rows (table, key, fp) sorted within a partition: links of each key's group.

    A group of more than ``limit`` goes on, row by row, with its key; it is never held.
    Result rows: a, b linked, or a alone with its table and key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_t = held_k = np.zeros(0, np.int64)
        held_f = np.zeros(0, np.uint64)
        hot = None

        def emit(pairs, t, k, f):
            a = np.array([x for x, _ in pairs], np.uint64).view(np.int64)
            b = np.array([y for _, y in pairs], np.uint64).view(np.int64)
            n = len(f)
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([a, f.view(np.int64)])),
                pa.array(np.concatenate([b, f.view(np.int64)])),
                pa.array(np.concatenate([np.full(len(a), -1), t])),
                pa.array(np.concatenate([np.zeros(len(a), np.int64), k]))], names=["a", "b", "t", "k"])

        def work(t, k, f, last):
            """Yields for whole groups; returns the rows of the last one unless ``last``."""
            nonlocal hot
            pairs, ht, hk, hf = [], [], [], []
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(t)]])
            if len(t) == 0:
                return [], t, k, f, (t, k, f)
            big = ends - starts > 1
            tail = slice(len(t), len(t))
            if not last:
                tail = slice(int(starts[-1]), len(t))
                big[-1] = False
            if hot is not None:
                # The first group goes on from one that is handed on already.
                if (int(t[0]), int(k[0])) == hot:
                    ht.append(t[:ends[0]]), hk.append(k[:ends[0]]), hf.append(f[:ends[0]])
                    big[0] = False
                    if len(starts) == 1:
                        tail = slice(len(t), len(t))
                    else:
                        hot = None
                else:
                    hot = None
            for i in np.flatnonzero(big):
                a, b = int(starts[i]), int(ends[i])
                if b - a > limit:
                    ht.append(t[a:b]), hk.append(k[a:b]), hf.append(f[a:b])
                else:
                    pairs += links(f[a:b], radius)
            if tail.stop - tail.start > limit:
                hot = (int(t[tail.start]), int(k[tail.start]))
                ht.append(t[tail]), hk.append(k[tail]), hf.append(f[tail])
                tail = slice(len(t), len(t))
            none = np.zeros(0, np.int64)
            handed = (np.concatenate(ht or [none]), np.concatenate(hk or [none]),
                      np.concatenate(hf or [none.view(np.uint64)]))
            return pairs, t[tail], k[tail], f[tail], handed

        for batch in batches:
            t, k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            t, k = np.concatenate([held_t, t]), np.concatenate([held_k, k])
            f = np.concatenate([held_f, f.view(np.uint64)])
            pairs, held_t, held_k, held_f, handed = work(t, k, f, False)
            if pairs or len(handed[0]):
                yield emit(pairs, *handed)
        pairs, _, _, _, handed = work(held_t, held_k, held_f, True)
        if pairs or len(handed[0]):
            yield emit(pairs, *handed)

    return run


def near_links(fps: DataFrame, radius: int, limit: int = GROUP) -> DataFrame:
    """Links (a, b), enough to connect all distinct fingerprints ``fp`` within ``radius`` bits.

    Groups that share a key in one table and are larger than ``limit`` are cut by a fresh set of
    covering masks, which keeps every pair within the radius together in some part; the bits that
    a key fixes at least double their share each round, so groups end.
    """
    # A group is told apart by its round, the masks that made it (path) and the kept bits (key).
    todo = fps.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("kept"))
    found, round_ = None, 0
    while True:
        table = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(signed(m)).alias("m"))
                          for i, m in enumerate(masks(radius, round_))])
        size = (1 << (radius + 1)) - 1
        rows = todo.select("fp", "path", "kept", F.explode(table).alias("x")).select(
            (F.col("path") * size + F.col("x.i")).alias("t"),
            F.col("kept").bitwiseOR(F.col("x.m")).alias("kept"), "fp")
        rows = rows.select("t", F.col("fp").bitwiseAND(F.col("kept")).alias("k"), "fp", "kept")
        groups = rows.select("t", "k", "fp").repartition("t", "k").sortWithinPartitions("t", "k")
        got = staged(groups.mapInArrow(compare_sorted(radius, limit), "a long, b long, t long, k long"),
                     "links")
        pairs = got.filter("t < 0").select("a", "b")
        found = pairs if found is None else found.union(pairs)
        hot = got.filter("t >= 0")
        if hot.isEmpty():
            return found
        # What a table keeps follows from its number, round by round.
        path = F.col("t")
        todo = hot.select(F.col("a").alias("fp"), path.alias("path"),
                          kept_bits(path, radius, round_).alias("kept"))
        round_ += 1


def kept_bits(t, radius: int, round_: int):
    """The mask that table number ``t`` of a round keeps: its own and those of the rounds before."""
    size = (1 << (radius + 1)) - 1
    out = F.lit(0).cast("long")
    for r in range(round_, -1, -1):
        lookup = F.array(*[F.lit(signed(m)) for m in masks(radius, r)])
        out = out.bitwiseOR(F.element_at(lookup, (t % size + 1).cast("int")))
        t = F.floor(t / size) if r else t
    return out


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of an edge ``a``, ``b``.

    Alternates two steps until nothing changes: hang every larger neighbour on a node's smallest
    neighbour, then every smaller one. Each step is a grouped minimum and a join of written
    tables, so a node with very many neighbours is split by the adaptive skew join.
    """

    def step(e: DataFrame, larger: bool) -> DataFrame:
        both = e if not larger else e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = staged(both.groupBy("a").agg(F.min("b").alias("m")), "low").select(
            F.col("a").alias("n"), F.least("a", "m").alias("m"))
        hung = both.join(low, F.col("a") == F.col("n"))
        if larger:
            out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return staged(out.filter("a <> b").distinct(), "edges")

    def sign(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter("a <> b").distinct(), "edges")
    before = sign(e)
    while before[0]:
        e = step(step(e, True), False)
        now = sign(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, radius: int = 4, limit: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: the id, fingerprint (16 hex digits), component_id.

    Texts are linked when their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest id reachable. Empty, blank and null texts have fingerprint zero and are linked like
    any other. Repeated rows come back as often. A row with a null id takes part and gets its
    component's id; a component without any id has null. An empty table gives no rows. Other
    columns are not read.

    Links and components work on distinct fingerprints only, so copies cost one row.
    """
    def make():
        return lambda texts: [[signed(fingerprint(x, shingle)) for x in texts]]

    rows = staged(text_map(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")),
                           "text", "fp long", make, ["id"]), "fingerprints")
    # One row per fingerprint: fp, and the smallest id that has it.
    fps = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    comp = components(near_links(fps.select("fp"), radius, limit))
    whole = fps.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = staged(whole, "whole")
    least = staged(whole.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = staged(whole.select("fp", "root").join(least, "root").select(
        F.col("fp").alias("fp2"), "component_id"), "named")
    return rows.join(named, F.col("fp") == F.col("fp2")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             radius: int = 4) -> DataFrame:
    """The rows whose id is their component's id, with their columns as they were.

    Repeated rows that share the smallest id are one document; all of them stay. Rows with a null
    id stay, for nothing tells them from others.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    name = unused(docs.columns, "#gone")
    gone = found.filter(F.col(f"`{id_col}`") != F.col("component_id")).select(
        F.col(f"`{id_col}`").alias(name)).distinct()
    # Always a merge join: what moves must not depend on whether the list fits a broadcast.
    return docs.join(staged(gone, "gone").hint("merge"), F.col(f"`{id_col}`") == F.col(name), "left_anti")
