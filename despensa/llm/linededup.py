"""Line dedup: three-line windows that were seen before go, where they overlap as one passage."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from despensa.llm.base import slices, staged, text_map

WINDOW = 3


def lines_of(text: str) -> tuple[list[str], list[int]]:
    """Lines, and the numbers of those that are not blank."""
    lines = text.split("\n")
    return lines, [i for i, x in enumerate(lines) if x.strip(" \t\r")]


def window_hashes(text: str, size: int) -> list[bytes]:
    """One 128-bit hash for every run of ``size`` lines that are not blank, ends trimmed."""
    lines, at = lines_of(text)
    told = [lines[i].strip(" \t\r") for i in at]
    return [xxhash.xxh3_128_digest("\n".join(told[i:i + size])) for i in range(len(told) - size + 1)]


def without(text: str, first: list[int], size: int) -> tuple[str, int]:
    """The text without the lines that windows starting at these (unblank) lines cover.

    Covered spans that touch or overlap are merged; blank lines inside a span go with it.
    """
    lines, at = lines_of(text)
    gone, end = [], -1
    for i in sorted(first):
        a, b = at[i], at[i + size - 1] + 1
        if a <= end:
            gone[-1][1] = end = max(end, b)
        else:
            gone.append([a, b])
            end = b
    out, last = [], 0
    for a, b in gone:
        out += lines[last:a]
        last = b
    out += lines[last:]
    return "\n".join(out), len(lines) - len(out)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = WINDOW, counted: str = "lines_removed") -> DataFrame:
    """``docs`` with the later occurrences of repeated windows of ``size`` lines removed.

    A window is ``size`` consecutive lines that are not blank, compared without the blanks at
    their ends. Occurrences are ordered by id (null first), hash of the text, then place; the first
    one stays, the lines covered by any later one go, so the first occurrence of every line stays.
    Texts with fewer lines than a window never change. All columns come back, ``text_col`` cleaned
    and the number of lines taken added as ``counted`` (replacing a column of that name). Null texts stay null, a text all
    of whose lines are repeats becomes empty, and no row is dropped. Rows with the same id and the
    same text are one document and all get its result. The table may be empty.

    Windows are counted by hash with partial sums; those found more than once are written and
    joined back as plain tables, so that the adaptive skew join splits a passage which a third of
    all rows share.
    """
    cols = [c for c in docs.columns if c != counted]
    plain = [f"c{i}" for i in range(len(cols))]
    text, doc = plain[cols.index(text_col)], plain[cols.index(id_col)]
    rows = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(cols, plain)])
    rows = rows.withColumn("th", F.xxhash64(text))

    def hashes():
        return lambda texts: [[window_hashes(x, size) for x in texts]]

    windows = staged(
        text_map(rows, text, "h array<binary>", hashes, [doc, "th"])
        .select(F.col(doc).alias("d"), "th", F.posexplode("h").alias("at", "h")), "windows")
    first = staged(
        windows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "th", "at")).alias("f"))
        .filter("n > 1").select("h", F.col("f.d").alias("fd"), F.col("f.th").alias("fth"),
                                F.col("f.at").alias("fat")), "repeated")
    later = staged(
        windows.join(first.hint("merge"), "h").filter("NOT (d <=> fd AND th = fth AND at = fat)")
        .groupBy("d", "th").agg(F.collect_set("at").alias("later")), "later")
    # Always a merge join: which rows move must not depend on whether the list of repeats happens
    # to fit a broadcast.
    joined = rows.join(later.withColumnRenamed("th", "th2").hint("merge"),
                       (F.col(doc).eqNullSafe(F.col("d"))) & (F.col("th") == F.col("th2")), "left")
    schema = T.StructType([*rows.select(*plain).schema.fields,
                           T.StructField("removed", T.IntegerType())])
    where = plain.index(text)

    def clean(batches):
        for batch in batches:
            for part in slices(batch, where):
                texts, removed = part.column(where).to_pylist(), []
                for i, at in enumerate(part.column(len(plain)).to_pylist()):
                    n = 0
                    if at:
                        texts[i], n = without(texts[i], at, size)
                    removed.append(n)
                arrays = list(part.columns[:-1])
                arrays[where] = pa.array(texts, arrays[where].type)
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(removed, pa.int32())], names=schema.names)

    out = joined.select(*plain, "later").mapInArrow(clean, schema)
    return out.toDF(*cols, counted)
