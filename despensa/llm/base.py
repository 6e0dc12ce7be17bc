"""What several operators share: staged tables, row-wise Arrow maps, word-piece ids."""

from __future__ import annotations

import pickle
import re
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from despensa.soporte import ruta_nueva

# Rows a Python function works on at a time, and the text they may hold. Long texts make small
# batches; the rows of one Arrow batch are cut further by these bounds, none is dropped.
ROWS_AT_ONCE, CHARS_AT_ONCE = 1024, 4_000_000


def staged(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back.

    The plan behind it runs once, lost executors cost a task, and later reads prune columns.
    """
    path = ruta_nueva(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcasts a value of this package's own classes by value: executors need no copy of the package."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text falls on ``remainder``; false for a null id."""
    c = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus == remainder
    return F.coalesce(c, F.lit(False))


def unused(names: list[str], wanted: str) -> str:
    """A column name that ``names`` does not hold."""
    while wanted in names:
        wanted += "_"
    return wanted


def arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(),
             T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(),
             T.FloatType(): pa.float32()}

    def of(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(of(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([(f.name, of(f.dataType)) for f in t])
        return kinds[t]

    return pa.schema([(f.name, of(f.dataType)) for f in schema])


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part keeps to ROWS_AT_ONCE and, by column ``text``, CHARS_AT_ONCE."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(
        zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= ROWS_AT_ONCE or held + n > CHARS_AT_ONCE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if len(sizes) > start:
        yield batch.slice(start, len(sizes) - start)


def text_map(df: DataFrame, text: str, added: str, make: Callable, keep: list[str] | None = None
             ) -> DataFrame:
    """Adds columns computed from ``text``, a few rows at a time.

    ``make()`` runs once a task and returns ``f(texts) -> list of columns`` for the fields of the
    schema ``added``; a null text arrives as the empty string. ``keep`` names the columns that go
    along (all by default); one that clashes with a result gives way to it.
    """
    new = T._parse_datatype_string(added)
    keep = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    rest = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(unused(keep, "#text")))
    schema = T.StructType([*rest.schema.fields[:-1], *new.fields])
    target = arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in slices(batch, len(keep)):
                texts = [x or "" for x in part.column(len(keep)).to_pylist()]
                cols = [pa.array(x, t) for x, t in zip(f(texts), target.types)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *cols], names=[*keep, *target.names])

    return rest.mapInArrow(run, schema)


# Fixed facts of the tokenizer format: bytes are written as printable characters, those that are
# not printable as the characters from U+0100 on (the byte-level alphabet of public BPE files).
PRINTABLE = (range(33, 127), range(161, 173), range(174, 256))


def byte_letters() -> dict[int, str]:
    plain = [b for r in PRINTABLE for b in r]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Known(dict):
    """Remembers ``make(key)`` for keys that are not too long, ``most`` of them at least.

    When it is full what it holds becomes the older half, where a key that is asked for again is
    found, and what was older goes: rare keys leave, frequent ones stay.
    """

    def __init__(self, make: Callable[[str], bytes], most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class WordIds:
    """Ids that the ``tokenizers`` library gives a whole text, without special tokens added.

    A pre-token never holds white space, so the pieces between white space are encoded on their
    own and remembered. Lower-cased words of the Latin blocks go to the library's BPE model as
    pre-tokens; a piece with any other character (or what could be a special token) goes through
    the library's whole pipeline. The memory is bounded and only saves time.
    """

    LATIN = "[\t\n\r\x20-\x7e¡-ɏ]*"
    KEEP = 600_000
    BLANKS = bytes.maketrans(b"\t\n\r", b"   ")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters, numbers = (
            "".join(re.escape(chr(c)) for c in range(0xA1, 0x250)
                    if unicodedata.category(chr(c))[0] == k) for k in "LN")
        letters, numbers = "a-zA-Z" + letters, "0-9" + numbers
        # The pre-token pattern of the file, with its classes written out for the Latin blocks.
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|"
                                 f"[^\\s{letters}{numbers}]+").findall
        self.latin = re.compile(self.LATIN).fullmatch
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.tokens, self.words, self.others, self.spelled = (
            Known(make, self.KEEP) for make in (self._token, self._word, self._other, lambda w: self._word(w.decode())))

    @classmethod
    def shared(cls, path: str) -> WordIds:
        """The one of this Python process: tasks that follow each other share what is remembered."""
        home = sys.modules.setdefault("despensa_word_ids", types.ModuleType("despensa_word_ids"))
        held = home.__dict__.setdefault("held", {})
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def _token(self, t: str) -> bytes:
        # Printable ASCII stands for itself in the alphabet.
        spelled = t if t.isascii() else t.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [x.id for x in self.model.tokenize(spelled)]).tobytes()

    def _word(self, w: str) -> bytes:
        parts = self.pieces(w)
        # A word of one piece is remembered as a word, not once more as a piece.
        return self._token(parts[0]) if len(parts) == 1 else b"".join(map(self.tokens.__getitem__, parts))

    def _other(self, w: str) -> bytes:
        if "<|" not in w and self.latin(w):
            return self._word(w.lower())
        return np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of several texts. Words are split and numbered by column, so each distinct word of
        these texts is looked up once; other characters than those of the Latin blocks go text by text."""
        out: list = [None] * len(texts)
        easy = [i for i, t in enumerate(texts) if "<|" not in t and self.latin(t)]
        for i in set(range(len(texts))).difference(easy):
            out[i] = self(texts[i])
        if not easy:
            return out
        # A text ends with a character that none of them holds.
        joined = " \0 ".join([texts[i] for i in easy] + [""]).lower().encode().translate(self.BLANKS)
        words = pa.compute.split_pattern(pa.array([joined], pa.binary()), " ").flatten().dictionary_encode()
        spelled = words.dictionary.to_pylist()
        known = [self.spelled[w] if w and w != b"\0" else b"" for w in spelled]
        size = np.array([len(k) // 4 for k in known], np.int64)
        ids, first = np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size
        at = words.indices.to_numpy()
        number = size[at]
        end = np.cumsum(number)
        flat = ids[np.repeat(first[at] - end + number, number) + np.arange(int(end[-1]))]
        stops = end[at == spelled.index(b"\0")]
        for i, a, b in zip(easy, [0, *stops], stops):
            out[i] = flat[a:b]
        return out

    def __call__(self, text: str) -> np.ndarray:
        if "<|" not in text and self.latin(text):
            ids = b"".join(map(self.words.__getitem__, text.lower().split()))
        else:
            ids = b"".join(map(self.others.__getitem__, re.split("[\t\n\r ]+", text)))
        return np.frombuffer(ids, "<u4")


def tokenizer_path() -> str:
    """The vocabulary file of the box's public tokenizers; operators take any path instead."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
