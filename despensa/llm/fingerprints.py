"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over the last seven bytes. Where it is a multiple of the block size, a piece ends; a
letter of the signature stands for the hash of a piece. The block size, a power of two, is the
smallest with at most 64 ends, so a signature covers the whole text and its length is bounded;
the signature of twice the block size stands beside it. An edit changes the letters of the pieces it
touches and no others. Signatures of the same block size are compared by edit distance.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despensa.llm.base import shuffle_partitions, slices, staged, text_map

ENDS, WINDOW, RUN = 64, 7, 7
# Bytes hashed at a time: a bound on memory, not on texts.
BLOCK = 1 << 20
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Weights of the window's bytes: odd powers of a multiplier, modulo 2^32.
WEIGHTS = [pow(0x9E3779B1, j, 1 << 32) for j in range(1, WINDOW + 1)]


def rolled(data: bytes, start: int, end: int) -> np.ndarray:
    """The rolling hash at every byte from ``start`` to ``end``; bytes before the text are none."""
    lead = min(start, WINDOW - 1)
    b = np.frombuffer(data, np.uint8, end - start + lead, start - lead).astype(np.uint32) + np.uint32(1)
    h = b * np.uint32(WEIGHTS[0])
    for j in range(1, min(WINDOW, len(b))):
        h[j:] += b[:-j] * np.uint32(WEIGHTS[j])
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (h ^ (h >> np.uint32(13)))[lead:]


class Ends:
    """Where pieces of a text end, by level: the block size is two to the level."""

    def __init__(self, data: bytes):
        self.data = data
        self.only = rolled(data, 0, len(data)) if 0 < len(data) <= BLOCK else None

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        if self.only is not None:
            yield 0, self.only
        else:
            for start in range(0, len(self.data), BLOCK):
                yield start, rolled(self.data, start, min(start + BLOCK, len(self.data)))

    def count(self, level: int) -> int:
        if level > 32:
            return 0
        mask = np.uint32((1 << level) - 1)
        return sum(len(h) - np.count_nonzero(h & mask) for _, h in self.blocks())

    def at(self, level: int) -> list[int]:
        if level > 32:
            return []
        mask = np.uint32((1 << level) - 1)
        return [int(i) + start + 1 for start, h in self.blocks() for i in np.flatnonzero((h & mask) == 0)]

    def level(self) -> int:
        level = max(0, (len(self.data) // ENDS).bit_length() - 1)
        while self.count(level) > ENDS:
            level += 1
        while level and self.count(level - 1) <= ENDS:
            level -= 1
        return level


def signature(data: bytes, ends: list[int]) -> str:
    if not ends or ends[-1] != len(data):
        ends = [*ends, len(data)]
    view, out, start = memoryview(data), [], 0
    for end in ends:
        if end > start:
            out.append(LETTERS[zlib.crc32(view[start:end]) & 63])
        start = end
    return "".join(out)


def fingerprint(text: str) -> str:
    """block size:signature:signature at twice the block size; ``1::`` for the empty text."""
    data = text.encode()
    ends = Ends(data)
    level = ends.level()
    return f"{1 << level}:{signature(data, ends.at(level))}:{signature(data, ends.at(level + 1))}"


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time as bits of one number."""
    full = (1 << len(a)) - 1
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    v = full
    for x in b:
        u = v & places.get(x, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def alike(a: str, b: str) -> float:
    """1 - (insertions + deletions that turn one into the other) / (both lengths).

    0 without a common run of seven letters, or of half the shorter signature if that is less:
    single letters agree by chance.
    """
    run = min(RUN, (min(len(a), len(b)) + 1) // 2)
    if not run:
        return 0.0
    runs = {a[i:i + run] for i in range(len(a) - run + 1)}
    if not any(b[i:i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * common(a, b) / (len(a) + len(b))


def likeness(a: str | None, b: str | None) -> float | None:
    """Likeness of two fingerprints, 0 to 1; 1 if they are the same, 0 at block sizes that share none."""
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    (m, a1, a2), (n, b1, b2) = a.split(":"), b.split(":")
    m, n = int(m), int(n)
    pairs = [(a1, b1), (a2, b2)] if m == n else [(a1, b2)] if m == 2 * n else [(a2, b1)] if n == 2 * m else []
    return max((alike(x, y) for x, y in pairs), default=0.0)


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole text as ``name`` (replacing a column of that name).

    Null texts count as empty. Equal texts have equal fingerprints.
    """
    def make():
        return lambda texts: [[fingerprint(t) for t in texts]]

    return text_map(docs, text_col, f"`{name}` string", make)


def compared(pairs: DataFrame, a: str, b: str, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of the fingerprints in columns ``a`` and ``b``; null beside a null."""
    told = F.pandas_udf(lambda x, y: pd.Series([likeness(i, j) for i, j in zip(x, y)], dtype="float64"), "double")
    return pairs.withColumn(name, told(F.col(f"`{a}`"), F.col(f"`{b}`")))


# Edited texts: every document beside the one that follows it.

ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
SPLIT = f"place long, part string, {ROW}, packed binary, size long"
CUTS = (32, 512)


def edit(text: str, following: str, share: int = 3) -> str:
    """The last 1/share of the text (rounded down) replaced by as much of the start of the following one."""
    n = len(text) // share
    return text[:len(text) - n] + following[:n]


def place(docs: DataFrame, id_col: str) -> Column:
    """A number that rises as the id falls, null last: a bounded count of ranges of about equal size.

    An id that many rows share is cut further by a hash of the text, the order of its rows.
    """
    n = min(max(shuffle_partitions(docs.sparkSession) * 2, CUTS[0]), CUTS[1])
    id = F.col(f"`{id_col}`").cast("long")
    cuts = docs.select(F.percentile_approx(id, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c > id))
    often = [c for c in set(cuts) if cuts.count(c) > 1]
    shared = id.isin(often) if often else F.lit(False)
    return F.when(id.isNull(), (2 * n + 1) * 256 + F.col("hash")).when(
        shared, (2 * above + 1) * 256 + F.col("hash")).otherwise(2 * above * 256).cast("long")


def packed(text: str) -> bytes:
    return pa.compress(text.encode(), "zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> str:
    return pa.decompress(data, size, "zstd", asbytes=True).decode() if size else ""


def told(row: tuple, other: tuple) -> tuple:
    """A row of ROW from (doc_id, n_chars, fingerprint, text) of a document and of the one that follows."""
    changed = edit(row[3], other[3])
    mark = fingerprint(changed)
    return (row[0], row[1], hashlib.sha256(changed.encode()).hexdigest(), row[2], mark,
            likeness(row[2], mark), likeness(row[2], other[2]))


def table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
NAMES = [c.split()[0] for c in ROW.split(", ")]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document's text and of its text edited with the following document's.

    Documents follow each other by falling id, a whole number, the first after the last; null ids come last, rows
    of one id by a hash of the text. Columns doc_id, n_chars (code points), edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next: likeness to the edited text's
    fingerprint and to the following document's. Null texts are empty; a single document follows
    itself; every row comes back; an empty table gives none. Texts move once, compressed.
    """
    def make():
        def f(texts: list[str]) -> list[list]:
            data = [t.encode() for t in texts]
            digests = [hashlib.sha256(d).digest()[:16] for d in data]
            return [[len(t) for t in texts], [fingerprint(t) for t in texts], [packed(t) for t in texts],
                    [len(d) for d in data], digests]
        return f

    keys = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    read = text_map(keys, "text", "n_chars long, fingerprint string, packed binary, size long, digest binary", make, ["doc_id"])
    by_place = read.withColumn("hash", F.conv(F.hex(F.substring("digest", 1, 1)), 16, 10).cast("int")).withColumn(
        "place", place(keys, "doc_id"))
    ordered = by_place.select("place", "doc_id", "digest", "n_chars", "fingerprint", "packed", "size").repartition(
        shuffle_partitions(docs.sparkSession), "place").sortWithinPartitions("place", F.col("doc_id").desc_nulls_last(), "digest")
    none = (None,) * 3

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows beside the next one of their place; the first and the last of a place wait for others."""
        before, at = None, None
        names, kinds = ["place", "part", *NAMES, "packed", "size"], [pa.int64(), pa.string(), *KINDS, pa.binary(), pa.int64()]

        def waiting(part: str, where: int, row: tuple, data: tuple) -> tuple:
            return (where, part, row[0], row[1], None, row[2], *none, *data)

        for batch in batches:
            for piece in slices(batch, 5):
                out = []
                for where, id, _, n, mark, data, size in zip(*[c.to_pylist() for c in piece.columns]):
                    row, raw = (id, n, mark, unpacked(data, size)), (data, size)
                    if where == at:
                        out.append((where, "", *told(before[0], row), None, None))
                    else:
                        if before is not None:
                            out.append(waiting("last", at, *before))
                        out.append(waiting("first", where, row, raw))
                    before, at = (row, raw), where
                if out:
                    yield table(out, names, kinds)
        if before is not None:
            yield table([waiting("last", at, *before)], names, kinds)

    done = staged(ordered.mapInArrow(follow, SPLIT), "edited")
    # One row of each kind for every place, whose number is bounded.
    firsts = done.filter("part = 'first'")
    all_places = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = firsts.select("place", F.coalesce(F.lead("place").over(Window.orderBy("place")), F.first("place").over(all_places)).alias("after"))
    ends = (
        done.filter("part = 'last'").join(steps, "place")
        .join(firsts.select(*[F.col(c).alias(f"next_{c}") for c in ("place", "fingerprint", "packed", "size")]),
              F.col("after") == F.col("next_place"))
        .select("doc_id", "n_chars", "fingerprint", "packed", "size", "next_fingerprint", "next_packed", "next_size")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                id, n, mark, data, size, *after = [c[i].as_py() for c in batch.columns]
                yield table([told((id, n, mark, unpacked(data, size)), (None, None, after[0], unpacked(*after[1:])))], NAMES, KINDS)

    return done.filter("part = ''").select(*NAMES).unionByName(ends.mapInArrow(finish, ROW))
