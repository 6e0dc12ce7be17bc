"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank in the corpus, so frequent ones are small numbers. A number takes
one to four bytes; its length less one stands as two bits in a control byte, four numbers to a
control byte, and control bytes are kept apart from data bytes. Decoding looks each control byte
up in tables and gathers the data with numpy.

A folder holds ``ranks.bin`` (ids by rank, little-endian unsigned 32-bit), ``manifest.json`` (the
files and how many ids come before each) and ``ids-NNNNNN.bin``, in ascending order of document.
Such a file is: magic; control and data bytes of each document; one index entry per document (id
present, id, ids, control bytes, data bytes, signed 64-bit little-endian); number of documents and
of ids; magic.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa.llm.base import WordIds, shuffle_partitions, slices, staged, tokenizer_path
from despensa.soporte import ruta_nueva

# Fixed values of the file format.
MAGIC = b"DSPIDS01"
TAIL, TAIL_SIZE, ENTRY = "<qq8s", 24, 5

# By control byte: the lengths of its four numbers.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def encode(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    n = numbers.astype("<u4")
    size = 1 + (n > 0xFF).astype(np.uint8) + (n > 0xFFFF) + (n > 0xFFFFFF)
    code = np.zeros(-(-len(n) // 4) * 4, np.uint8)
    code[:len(n)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4) < size[:, None]
    return control.tobytes(), n.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``encode`` was given."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    used = np.arange(4) < size[:, None]
    out = np.zeros((n, 4), np.uint8)
    out[used] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def filesystem(path: str):
    """(file system, path) of a folder that all executors share."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        path = f"file://{path}" if path.startswith("/") else path
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def write_whole(folder: str, name: str, parts: list[bytes]) -> None:
    """Writes a file under a name of its own and moves it into place, so that a repeated or lost
    task leaves either the whole file or none."""
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    scratch = f"{root}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(scratch) as f:
        for p in parts:
            f.write(p)
    fs.move(scratch, f"{root}/{name}")


def tokenized(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """row, id, n, ids (16-bit where they fit, else 32-bit) of every document; staged.

    Each task adds a row of what it has counted: n = -1, and the ids it saw and how often, one after
    the other.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = WordIds.shared(path), TaskContext.get().partitionId() << 40
        total = np.zeros(1 << 16, np.int64)

        def table(rows, docs, count, packed) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(rows), docs, pa.array(count, pa.int64()), pa.array(packed, pa.binary())],
                names=["row", "id", "n", "ids"])

        for batch in batches:
            for part in slices(batch, 1):
                found = [np.append(x, np.uint32(end_id)) for x in words.many([t or "" for t in part.column(1).to_pylist()])]
                seen = np.bincount(np.concatenate(found))
                if len(seen) > len(total):
                    total = np.pad(total, (0, len(seen) - len(total)))
                total[:len(seen)] += seen
                yield table(np.arange(row, row + len(found)), part.column(0), [len(x) for x in found],
                            [x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in found])
                row += len(found)
        at = np.flatnonzero(total)
        if len(at):
            yield table([row], pa.array([None], pa.int64()), [-1], [np.concatenate([at, total[at]]).astype("<i8").tobytes()])

    return staged(rows.mapInArrow(run, "row long, id long, n long, ids binary"), "ids")


def plain(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def ranking(ids: DataFrame) -> np.ndarray:
    """All ids that occur, most frequent first, ties by id. Bounded by the vocabulary."""

    def run(batches):
        for batch in batches:
            for b in batch.column(0).to_pylist():
                at, n = np.frombuffer(b, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["id", "n"])

    counts = ids.filter("n < 0").select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return np.array([r["id"] for r in counts.orderBy(F.col("n").desc(), "id").collect()], np.int64)


class Writer:
    """One file: documents are added in order, ``close`` writes the index."""

    def __init__(self, folder: str, part: int):
        self.fs, self.root = filesystem(folder)
        self.name, self.part = f"ids-{part:06d}.bin", part
        self.scratch = f"{self.root}/.{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.scratch)
        self.out.write(MAGIC)
        self.at, self.numbers, self.index = len(MAGIC), 0, []

    def add(self, doc: int | None, numbers: np.ndarray) -> None:
        control, data = encode(numbers)
        self.out.write(control)
        self.out.write(data)
        self.at += len(control) + len(data)
        self.numbers += len(numbers)
        self.index.append((doc is not None, doc or 0, len(numbers), len(control), len(data)))

    def close(self) -> None:
        self.out.write(np.array(self.index, "<i8").tobytes())
        self.out.write(struct.pack(TAIL, len(self.index), self.numbers, MAGIC))
        self.out.close()
        self.fs.move(self.scratch, f"{self.root}/{self.name}")


def write_ids(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
              path: str | None = None, end_id: int = 2) -> str:
    """Writes all documents' ids, each with the end id, to files in a folder; returns the folder.

    Documents go in ascending order of id, null ids first, rows that share an id in the order the
    staged table holds them; an id that very many rows share is split over files. A null or empty
    text is its end id. ``id_col`` holds whole numbers. An empty table leaves no ``ids-`` file. Other columns are not read. The
    folder must be new and one that all executors see; by default it lies below the shared one.
    """
    spark = docs.sparkSession
    folder = folder or ruta_nueva(spark, "idfiles")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    ids = tokenized(docs, id_col, text_col, path or tokenizer_path(), end_id)
    by_rank = ranking(ids)
    write_whole(folder, "ranks.bin", [by_rank.astype("<u4").tobytes()])
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    held = spark.sparkContext.broadcast(rank)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file = TaskContext.get().partitionId(), None
        for batch in batches:
            file = file or Writer(folder, part)
            for doc, n, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                file.add(doc, held.value[plain(b, n)])
        if file:
            file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in (part, len(file.index), file.numbers)],
                names=["part", "docs", "numbers"])

    order = [F.asc_nulls_first("id"), F.asc("row")]
    done = (ids.filter("n > 0").repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
            .select("id", "n", "ids").mapInArrow(write, "part long, docs long, numbers long"))
    files, start = [], 0
    for r in sorted(done.collect()):  # one row per file
        files.append({"name": f"ids-{r['part']:06d}.bin", "docs": r["docs"], "start": start})
        start += r["numbers"]
    write_whole(folder, "manifest.json", [json.dumps({"ids": start, "files": files}).encode()])
    return folder


def read_file(folder: str, name: str) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
    """(ids of documents, their numbers of ids, their ranks), a few documents at a time."""
    fs, root = filesystem(folder)
    with fs.open_input_file(f"{root}/{name}") as f:
        f.seek(f.size() - TAIL_SIZE)
        docs, _, magic = struct.unpack(TAIL, f.read(TAIL_SIZE))
        if magic != MAGIC:
            raise ValueError(f"{name} is no id file")
        f.seek(f.size() - TAIL_SIZE - docs * ENTRY * 8)
        index = np.frombuffer(f.read(docs * ENTRY * 8), "<i8").reshape(docs, ENTRY)
        f.seek(len(MAGIC))
        sizes, a = index[:, 3] + index[:, 4], 0
        while a < docs:
            b = a + max(1, int(np.searchsorted(np.cumsum(sizes[a:a + 1000]), 4_000_000)))
            block, at, out = f.read(int(sizes[a:b].sum())), 0, []
            for n, c, d in index[a:b, 2:].tolist():
                out.append(decode(block[at:at + c], block[at + c:at + c + d], n))
                at += c + d
            yield [i if there else None for there, i in index[a:b, :2].tolist()], index[a:b, 2], out
            a = b


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian
    unsigned 32-bit) of every document in the files, one task per file."""
    fs, root = filesystem(folder)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        files = json.loads(f.read())["files"]

    def run(batches):
        with filesystem(folder)[0].open_input_stream(f"{root}/ranks.bin") as f:
            by_rank = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for nr in batch.column(0).to_pylist():
                start = files[nr]["start"]
                for docs, sizes, ranks in read_file(folder, files[nr]["name"]):
                    starts = start + np.cumsum(sizes) - sizes
                    start += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(starts), pa.array(sizes),
                         pa.array([by_rank[r].tobytes() for r in ranks], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
