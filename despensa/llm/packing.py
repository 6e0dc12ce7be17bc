"""Packing of token ids into fixed-length sequences by reciprocal-capacity (harmonic) classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from despensa.llm.base import WordIds, arrow_schema, slices, tokenizer_path, unused

# Sequences of one worker are numbered below this; the worker's number stands above it.
SEQUENCES = 1 << 40


def slot_lengths(n: int, capacity: int, slack: int) -> list[int]:
    """Lengths of the pieces a document of ``n`` ids is cut into.

    Full sequences are cut off first. A rest belongs to class k, capacity/(k+1) < rest <=
    capacity/k, whose slots have capacity//k places. If it would leave more than n // slack of
    them empty, a piece that fills a slot of the next class is cut off and the rest, now smaller
    than 1/k of it, goes on to a class of its own.
    """
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity // k - rest <= n // slack:
            out.append(rest)
            break
        cut = capacity // (k + 1)
        out.append(cut)
        rest -= cut
    return out


def powers(n: int, capacity: int) -> list[int]:
    """``n`` as full sequences and falling powers of two, lengths that need no padding."""
    out = [capacity] * (n // capacity)
    return out + [1 << b for b in reversed(range(capacity.bit_length())) if n % capacity >> b & 1]


class Worker:
    """The open bins of one worker, one for each class: fewer than 2 * sqrt(capacity) of them."""

    def __init__(self, first: int, capacity: int, slack: int):
        self.next, self.capacity, self.slack = first, capacity, slack
        self.open: dict[int, list] = {}
        self.out: list[tuple] = []

    def close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.out.append((doc, start, len(ids), n, self.next, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        for n in slot_lengths(len(ids), self.capacity, self.slack):
            k = self.capacity // n
            bin_ = self.open.setdefault(k, [])
            # A copy, so that an open bin holds its own ids and not those of a whole long text.
            bin_.append((doc, start, ids[start:start + n].copy(), len(ids)))
            start += n
            if len(bin_) == k:
                self.close(self.open.pop(k))

    def end(self) -> None:
        """Bins still open are laid end to end and cut anew, so that they need no padding."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        for size in powers(sum(len(p[2]) for p in left), self.capacity):
            pieces = []
            while size:
                doc, start, ids, n = left.pop(0)
                if len(ids) > size:
                    left.insert(0, (doc, start + size, ids[size:], n))
                    ids = ids[:size]
                pieces.append((doc, start, ids, n))
                size -= len(ids)
            self.close(pieces)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         capacity: int = 2048, end_id: int = 1, slack: int = 100) -> DataFrame:
    """One row per piece: the id column, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds little-endian unsigned 32-bit ids as binary. Each worker (a partition of
    ``docs``) fills bins of its own, k pieces to a bin of class k, in one pass without a shuffle;
    it holds one open bin per class and no more. ``capacity`` must be a power of two.

    A sequence shorter than ``capacity`` is padded to it by whoever stacks sequences, except one
    whose length is a power of two; see ``padding``.

    Null or empty texts: the end id alone. Null ids are kept. Repeated rows are packed once each.
    An empty table gives no rows. Other columns are not read. Sequence numbers depend on how the
    input is split into partitions and are the same when a task is run again.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = path or tokenizer_path()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias(unused([id_col], "#text")))
    schema = T.StructType([rows.schema[0], *T._parse_datatype_string(
        "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")])
    rest = arrow_schema(T.StructType(schema.fields[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordIds.shared(path)
        w = Worker(TaskContext.get().partitionId() * SEQUENCES, capacity, slack)
        kind = None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*w.out)) or [[] for _ in schema.fields]
            w.out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), *[pa.array(c, t) for c, t in zip(cols[1:], rest.types)]],
                names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for part in slices(batch, 1):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    w.add(doc, np.append(encode(text or ""), np.uint32(end_id)))
                yield flush()
        w.end()
        if w.out:
            yield flush()

    return rows.mapInArrow(run, schema)


def padding(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: ids, sequences, and places that padding fills in them."""
    seq = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    whole = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return seq.agg(F.sum("n").alias("ids"), F.count(F.lit(1)).alias("sequences"),
                   F.sum(F.when(whole, 0).otherwise(capacity - F.col("n"))).alias("padding"))
