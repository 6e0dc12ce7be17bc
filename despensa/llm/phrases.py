"""Collocations by Toivonen mining: a sample proposes, full passes count until nothing is open.

A share of the texts proposes phrases. The first full pass counts, by 64-bit key, every proposed phrase
and its negative border: all words, and every longer phrase whose parts (without the last word,
without the first) are proposed. A border phrase that turns out frequent is a failure: longer phrases that
hold it were not looked at. The second pass counts, by their spelling, all phrases found frequent and
whatever the failures open: every uncounted phrase whose parts are frequent or counted now. As all
words are counted in the first pass, by induction over the length that closes the search.
Counts that are returned come from the second pass alone, so two phrases with one key cost a
count and never change one.

What is proposed or frequent goes to the tasks as a Bloom filter of bounded size. A false
positive, too, counts a phrase more than needed and never changes a count.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from despensa.llm.base import arrow_schema, shuffle_partitions, slices, staged, unused

BREAKS = b".,;:!?\n\x0b\x0c\r"
# Bytes of text counted at a time and rows of a batch: bounds on a worker's memory.
BYTES, ROWS = 2_000_000, 20_000
# Bytes of keys and counts a task gathers before it adds up those that are the same, in so many stretches.
HELD, STRETCHES = 64_000_000, 16
# Merging tasks for each shuffle partition: runs move as large values, a batch of which is held at a time.
FINER = 3
# Bits of a filter: at least, at most (32 MB), and for each phrase in between.
BITS = (1 << 20, 1 << 28, 16)
COUNTS = "lang string, words int, phrase string, n long"
RUNS = "bucket int, keys binary, n binary"


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of a phrase from that of all but its last word and that of the last word."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bits) * 8 - 1)
    found = np.ones(len(keys), bool)
    for p in (keys & mask, (keys >> np.uint64(34)) & mask):
        found &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def at_places(bits: np.ndarray, keys: np.ndarray, where: np.ndarray) -> np.ndarray:
    """``has`` asked only where it matters, false elsewhere."""
    out, at = np.zeros(len(keys), bool), np.flatnonzero(where)
    out[at] = has(bits, keys[at])
    return out


class Part:
    """The words of a stretch of text of one language, numbered from 1; 0 is a break."""

    TABLE = bytes.maketrans(string.ascii_uppercase.encode() + b"\t" + BREAKS,
                            string.ascii_lowercase.encode() + b" " + b"\n" * len(BREAKS))

    def __init__(self, lang: str, text: bytes, longest: int, last: bool):
        tokens = pc.split_pattern(pa.array([text], pa.binary()), " ").flatten().dictionary_encode()
        words = tokens.dictionary.to_pylist()
        number = np.array([-1 if w == b"" else 0 if w == b"\n" else 1 for w in words], np.int64)
        real = np.flatnonzero(number == 1)
        number[real] = np.arange(1, len(real) + 1)
        self.lang, self.longest = lang, longest
        self.words = pa.concat_arrays([pa.array([b""]), tokens.dictionary.take(pa.array(real))])
        start = lang.encode() + b"\0"
        self.hashes = np.array([0, *[xxhash.xxh64_intdigest(start + words[i]) for i in real]], np.uint64)
        ids = number[tokens.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        ids, more = ids[ids >= 0], longest - 1
        # The last words wait for what follows, unless nothing does.
        self.starts = len(ids) if last else max(len(ids) - more, 0)
        waiting = ids[self.starts:]
        self.rest = b" ".join(w if i else b"\n" for i, w in zip(waiting, self.words.take(pa.array(waiting)).to_pylist()))
        self.ids = np.concatenate([ids, np.zeros(more if last else 0, np.int64)])

    def levels(self, proposed: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: keys of all places, where a phrase starts, where it is proposed or border."""
        ids = self.ids
        first, real = self.hashes[ids], ids > 0
        keys, whole, border = first, real, real
        yield 1, keys, whole, border
        for k in range(2, self.longest + 1):
            if proposed is not None:
                held = (has(proposed, self.hashes)[ids] if k == 2 else at_places(proposed, keys, border)) & border
            keys, whole = mixed(keys[:-1], first[k - 1:]), whole[:-1] & real[k - 1:]
            border = whole if proposed is None else held[:-1] & held[1:] & whole
            yield k, keys, whole, border

    def distinct(self, at: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The phrases of ``k`` words that start at these places: their words and counts."""
        ids, width = self.ids, len(self.words).bit_length()
        if k * width < 63:
            code = ids[at]
            for j in range(1, k):
                code = code << width | ids[at + j]
            code, n = np.unique(code, return_counts=True)
            return [code >> width * (k - 1 - j) & (1 << width) - 1 for j in range(k)], n
        code = ids[at]
        for j in range(1, k):
            code = np.unique(code, return_inverse=True)[1] * len(self.words) + ids[at + j]
        _, where, n = np.unique(code, return_index=True, return_counts=True)
        return [ids[at[where] + j] for j in range(k)], n


def parts(texts: Iterator[tuple[str, bytes]], longest: int) -> Iterator[Part]:
    """Cuts a stream of texts by language into parts of a bounded size; every phrase starts in one."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def cut(last: bool) -> Iterator[Part]:
        for lang in list(held):
            part = Part(lang, b" ".join(held[lang]), longest, last)
            if part.starts:
                yield part
            held[lang] = [part.rest]

    for lang, text in texts:
        told, at = text.translate(Part.TABLE).replace(b"\n", b" \n "), 0
        while at < len(told):
            end = told.find(b" ", at + BYTES)
            end = len(told) if end < 0 else end
            held.setdefault(lang, []).append(told[at:end])
            size, at = size + end - at, end
            if size >= BYTES:
                yield from cut(False)
                size = 0
        held.setdefault(lang, []).append(b"\n")
    yield from cut(True)


def text_bytes(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def streamed(texts: DataFrame, longest: int, counted: Callable[[Part], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            for piece in slices(batch, 1):
                yield from zip(piece.column(0).to_pylist(), text_bytes(piece.column(1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(rows(batches), longest):
            yield from counted(part)

    return texts.mapInArrow(run, schema)


def in_parts(columns: list[pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
    for i in range(0, len(whole), ROWS):
        yield whole.slice(i, ROWS)


def frequent_keys(texts: DataFrame, longest: int, proposed: Broadcast | None, at_least: int) -> DataFrame:
    """Keys that occur often enough: of all phrases, or of those proposed and their border.

    Keys and counts travel as sorted runs, at most one for each task that merges and part of a text: a row for
    each key would cost several times as much to move. A merging task holds the distinct keys of its
    share, so as elsewhere the number of shuffle partitions has to fit the data.
    """
    schema, ranges = arrow_schema(T._parse_datatype_string(RUNS)), FINER * shuffle_partitions(texts.sparkSession)

    def counted(part: Part) -> Iterator[pa.RecordBatch]:
        bits = None if proposed is None else np.frombuffer(proposed.value, np.uint8)
        found, n = np.unique(np.concatenate([
            keys[:part.starts][border[:part.starts]] for _, keys, _, border in part.levels(bits)]), return_counts=True)
        # Keys are hashes: ranges of them are of about equal size.
        ends = np.searchsorted(found, np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64))
        cuts = [(i, a, b) for i, (a, b) in enumerate(zip([0, *ends.tolist()], [*ends.tolist(), len(found)])) if b > a]
        yield from in_parts([
            pa.array([i for i, _, _ in cuts]), pa.array([found[a:b].tobytes() for _, a, b in cuts], pa.binary()),
            pa.array([n[a:b].astype("<u4").tobytes() for _, a, b in cuts], pa.binary())], schema)

    def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The runs as one, a stretch of keys at a time."""
        longest_run = max((k for k, _ in runs), key=len)
        bounds = longest_run[[len(longest_run) * i // STRETCHES for i in range(1, STRETCHES)]]
        cuts = [[0, *np.searchsorted(k, bounds).tolist(), len(k)] for k, _ in runs]
        for i in range(STRETCHES):
            keys = np.concatenate([k[c[i]:c[i + 1]] for (k, _), c in zip(runs, cuts)])
            if len(keys):
                n = np.concatenate([x[c[i]:c[i + 1]] for (_, x), c in zip(runs, cuts)]).astype(np.int64)
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                yield keys[first], np.add.reduceat(n[order], first)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch, 1):
                for keys, n in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                    held.append((np.frombuffer(keys, np.uint64), np.frombuffer(n, "<u4")))
                    size += len(keys) + len(n)
                if size > HELD:
                    held, size = [tuple(np.concatenate(x) for x in zip(*merged(held)))], 0
        for keys, n in merged(held) if held else ():
            yield pa.RecordBatch.from_arrays([pa.array(keys[n >= at_least].view(np.int64))], names=["key"])

    # All ranges of a task are added up together: its runs stay apart by their keys.
    return streamed(texts, longest, counted, RUNS).repartition(ranges, "bucket").mapInArrow(merge, "key long")


def filter_of(keys: DataFrame, most: int) -> bytes:
    """A Bloom filter of the keys. Its size is bounded, and with it what the driver gathers."""
    keys = staged(keys, "keys")
    wanted = max(BITS[0], min(most, keys.count() * BITS[2]))
    size = 1 << (wanted - 1).bit_length()
    size = size if size <= most else size // 2
    places = keys.select(F.explode(F.array(
        F.col("key").bitwiseAND(size - 1), F.shiftrightunsigned("key", 34).bitwiseAND(size - 1))).alias("p"))
    parts = places.groupBy(F.expr("p div 32768").alias("part")).agg(
        F.bitmap_construct_agg(F.col("p") % 32768).alias("bits")).collect()
    out = bytearray(size // 8)
    for part, bits in parts:
        out[part * 4096:part * 4096 + 4096] = bits
    return bytes(out)


def spelled_counts(texts: DataFrame, longest: int, proposed: Broadcast, frequent: Broadcast) -> DataFrame:
    """Counts, by spelling, of phrases whose key is frequent and of those that failures open; the
    sum of all words as a phrase of no word."""
    schema = arrow_schema(T._parse_datatype_string(COUNTS))

    def rows(part: Part, phrase: pa.Array, words: int, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from in_parts([pa.repeat(part.lang, len(n)), pa.array(np.full(len(n), words)), phrase, pa.array(n)], schema)

    def counted(part: Part) -> Iterator[pa.RecordBatch]:
        first, often = (np.frombuffer(b.value, np.uint8) for b in (proposed, frequent))
        all_words = np.count_nonzero(part.ids[:part.starts])
        yield from rows(part, pa.array([""]), 0, np.array([all_words]))
        member = None
        for k, keys, whole, border in part.levels(first):
            open_to = whole if member is None else member[:-1] & member[1:] & whole
            # A phrase the first pass has counted is known to be frequent or not; another one is open.
            member = open_to & (~border | at_places(often, keys, open_to & border))
            at = np.flatnonzero(member[:part.starts])
            if len(at):
                words, n = part.distinct(at, k)
                yield from rows(part, pc.binary_join_element_wise(*[part.words.take(pa.array(w)) for w in words], b" "), k, n)

    return streamed(texts, longest, counted, COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3,
                     at_least: int = 10, share: float = 0.25, most_bits: int = BITS[1]) -> DataFrame:
    """Every phrase of at most ``longest`` words that occurs ``at_least`` times in its language.

    Columns lang, words, phrase, n (exact, over all texts, overlaps included); the row of no words
    has the number of all word occurrences. A-Z are lower-cased, texts cut at ``.,;:!?`` and line
    ends, words at blanks and tabs; phrases don't reach over a cut. Null texts are empty, a null
    language is ``und``; texts of any length are read whole, repeated rows count as often as they
    occur, an empty table has no phrases. ``share`` of the texts (by hash) proposes: it changes how much
    the second pass has left to count, never a result.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    longest, send = max(longest, 2), docs.sparkSession.sparkContext.broadcast
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    often = max(2, round(at_least * share / 2))
    proposed = send(filter_of(frequent_keys(sample, longest - 1, None, often), most_bits))
    frequent = send(filter_of(frequent_keys(texts, longest, proposed, at_least), most_bits))
    # The row of no words holds a language's size and stays whatever it is.
    return staged(spelled_counts(texts, longest, proposed, frequent).filter(
        (F.col("n") >= at_least) | (F.col("words") == 0)), "phrases")


def first_of_each(df: DataFrame, group: str, order: list[Column], salt: Column, first: int, rank: str) -> DataFrame:
    """The first rows of every group with their rank, in rounds: no task sorts a whole group."""
    parts, cut = shuffle_partitions(df.sparkSession), unused(df.columns, "#part")
    df = df.withColumn(cut, F.pmod(salt, F.lit(parts)))
    while True:
        w = Window.partitionBy(group, cut).orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= first)
        if parts == 1:
            return df.drop(cut)
        parts = -(-parts // 16)
        df = df.withColumn(cut, F.pmod(F.col(cut), F.lit(parts)))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3,
                 at_least: int = 10, first: int = 2000, inside: int = 50, **how) -> DataFrame:
    """The ``first`` phrases of two words or more of each language, by score.

    A phrase that occurs a times, cut into parts that occur l and r times, scores
    floor(1000000 a a / (l r)), the lowest of its cuts (the earliest among equal ones). Phrases
    inside a longer one that occurs at ``inside`` percent of their count or more are left out. Order:
    score and count descending, phrase ascending. Columns lang, rank, phrase, a, l, r, n (words of
    the language), score. Null and empty texts, languages and tables as in ``frequent_phrases``; a
    language without a phrase has no row. Counts below 10^15 are exact.
    """
    found = frequent_phrases(docs, text_col, lang_col, longest, at_least, **how)
    words = F.split("phrase", " ")
    part = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    count = F.col("words")
    known = found.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    cuts = (
        found.filter("words > 1")
        .select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), count - 1)).alias("cut"))
        .withColumns({"left": part(F.lit(1), F.col("cut")), "right": part(F.col("cut") + 1, count - F.col("cut"))})
        .join(known.select("lang", F.col("part").alias("left"), F.col("times").alias("l")), ["lang", "left"])
        .join(known.select("lang", F.col("part").alias("right"), F.col("times").alias("r")), ["lang", "right"])
    )
    d = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = cuts.withColumn("top", d("a") * d("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("low", d("l") * d("r"))
    scored = (
        cuts.withColumn("score", F.expr("top div low"))
        .groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("best"))
        .select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")
    )
    shorter = (
        found.filter("words > 2")
        .select("lang", "n", "words", "phrase", F.explode(F.sequence(F.lit(2), count - 1)).alias("size"))
        .select("lang", "n", F.explode(F.transform(
            F.sequence(F.lit(1), count - F.col("size") + 1), lambda a: part(a, F.col("size")))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    )
    kept = scored.join(shorter, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)).drop("longer")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = first_of_each(kept, "lang", order, F.xxhash64("phrase"), first, "rank")
    size = found.filter("words = 0").groupBy("lang").agg(F.sum("n").alias("all_words"))
    return ranked.join(size, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
