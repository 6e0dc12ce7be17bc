"""Benchmark decontamination over a positional inverted index of the training documents.

The index is cut into shards: every shard holds the postings (term -> places) of some whole
documents, and is one row of a written table. A phrase is searched by taking the postings of its
rarest term in the corpus, shifted to where the phrase would start, and intersecting them with the
shifted postings of the next rarest, until all terms agree (exact) or nearly agree (proximity).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from despensa.llm.base import arrow_schema, slices, staged

# Words are runs of ASCII digits and letters and of all that is not ASCII, with A-Z lower-cased:
# every other ASCII byte of the UTF-8 text becomes a blank.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
                 for b in range(256))
# A shard closes at this many words; one longer document is a shard of its own.
SHARD_WORDS = 400_000
# Items searched in one pass: what a pass sends to every worker is bounded by these.
PASS_ITEMS, PASS_CHARS = 20_000, 20_000_000


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(TO_WORDS).split()


def term(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


INDEX = ("shard long, ids array<{id}>, base array<long>, n_words array<long>, terms binary, "
         "ends binary, places binary")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = 64,
                shard_words: int = SHARD_WORDS) -> DataFrame:
    """Writes the index and returns it: one row per shard.

    ``terms`` are the 64-bit hashes of the shard's words in order, ``ends`` where each one's
    places end, ``places`` all postings: positions in the shard, where document i starts at
    ``base[i]`` and ``gap`` positions stay free between documents.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = T._parse_datatype_string(INDEX.format(id=rows.schema[0].dataType.simpleString()))
    kinds = arrow_schema(T.StructType(schema.fields[2:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        ids, base, n_words, words, at, kind = [], [], [], [], 0, None
        nr = TaskContext.get().partitionId() << 32

        def shard():
            number = np.fromiter((known.setdefault(w, len(known)) for ws in words for w in ws), np.int64)
            place = np.concatenate([np.arange(b, b + n) for b, n in zip(base, n_words)] or [[]])
            hashes = np.fromiter(map(term, known), np.uint64, len(known))
            by_hash = np.argsort(hashes)
            rank = np.empty(len(hashes), np.int64)
            rank[by_hash] = np.arange(len(hashes))
            owner = rank[number]
            order = np.argsort(owner, kind="stable")
            ends = np.cumsum(np.bincount(owner, minlength=len(hashes)))
            return pa.RecordBatch.from_arrays([
                pa.array([nr], pa.int64()), pa.array([ids], pa.list_(kind)),
                pa.array([base], kinds[0].type), pa.array([n_words], kinds[1].type),
                pa.array([hashes[by_hash].astype("<u8").tobytes()], pa.binary()),
                pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                pa.array([place[order].astype("<i4" if at < 1 << 31 else "<i8").tobytes()], pa.binary())],
                names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for part in slices(batch, 1):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ws = words_of(text or "")
                    if ids and at + len(ws) > shard_words:
                        yield shard()
                        known, ids, base, n_words, words, at, nr = {}, [], [], [], [], 0, nr + 1
                    ids.append(doc), base.append(at), n_words.append(len(ws)), words.append(ws)
                    at += len(ws) + gap
        if ids:
            yield shard()

    return staged(rows.mapInArrow(run, schema), "index")


class Shard:
    """The postings of one index row."""

    def __init__(self, row: dict):
        self.ids, self.base = row["ids"], np.array(row["base"], np.int64)
        self.n_words = np.array(row["n_words"], np.int64)
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.ends = np.frombuffer(row["ends"], "<i8")
        n = int(self.ends[-1]) if len(self.ends) else 0
        self.places = np.frombuffer(row["places"], "<i4" if len(row["places"]) == 4 * n else "<i8")

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Number of each wanted term here, -1 for one that does not occur."""
        if not len(self.terms):
            return np.full(wanted.shape, -1)
        i = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return np.where(self.terms[i] == wanted, i, -1)

    def postings(self, i: int) -> np.ndarray:
        return self.places[self.ends[i - 1] if i else 0:self.ends[i]].astype(np.int64)


def corpus_frequencies(index: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """How often each wanted term occurs in the whole corpus; reads the term columns alone."""
    held = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        w = held.value
        total = np.zeros(len(w), np.int64)
        for batch in batches:
            for terms, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms, ends = np.frombuffer(terms, "<u8"), np.frombuffer(ends, "<i8")
                if len(terms):
                    i = np.minimum(np.searchsorted(terms, w), len(terms) - 1)
                    total += np.where(terms[i] == w, np.diff(ends, prepend=0)[i], 0)
        there = total > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(w[there].view(np.int64)), pa.array(total[there])], names=["t", "n"])

    got = index.select("terms", "ends").mapInArrow(run, "t long, n long")
    return {r["t"] & (1 << 64) - 1: r["n"]
            for r in got.groupBy("t").agg(F.sum("n").alias("n")).collect()}


def phrases_of(items: list[tuple], size: int) -> tuple[np.ndarray, np.ndarray, list[list]]:
    """Distinct windows as rows of term hashes (0 where shorter), their lengths, who has them."""
    owners: dict[tuple[int, ...], dict] = {}
    for item, text in items:
        t = [term(w) for w in words_of(text or "")]
        for i in range(max(len(t) - size, 0) + 1 if t else 0):
            owners.setdefault(tuple(t[i:i + size]), {})[item] = True
    rows = np.zeros((len(owners), size), np.uint64)
    for r, p in zip(rows, owners):
        r[:len(p)] = p
    return rows, np.array([len(p) for p in owners], np.int64), [list(x) for x in owners.values()]


def intersect(shard: Shard, numbers: np.ndarray, order: np.ndarray, slop: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """Starts of a phrase in a shard, and the largest distance of a term from its place there.

    ``numbers`` are the phrase's terms in the shard, ``order`` its places from the rarest on. The
    rarest one's postings, shifted by its place, are the candidates; each further list keeps
    those that have a posting within ``slop`` of the expected position.
    """
    first = int(order[0])
    starts = shard.postings(int(numbers[first])) - first
    off = np.zeros(len(starts), np.int64)
    for j in order[1:]:
        if not len(starts):
            break
        p = shard.postings(int(numbers[j]))
        want = starts + int(j)
        i = np.searchsorted(p, want)
        after = np.abs(p[np.minimum(i, len(p) - 1)] - want)
        before = np.abs(p[np.maximum(i - 1, 0)] - want)
        distance = np.minimum(after, before)
        near = distance <= slop
        starts, off = starts[near], np.maximum(off, distance)[near]
    return starts, off


MATCH = "array<struct<item:{item},start:long,length:long,exact:boolean>>"


SPANS = "array<struct<start:long,length:long>>"


def search(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text",
           size: int = 10, slop: int = 0, every: bool = True) -> DataFrame:
    """One row per document: id, n_words, spans, items, and matches if ``every`` one is wanted.

    ``spans`` are the stretches (start, length in words) inside exact occurrences, merged, ``items``
    the items that have one: at most as many as the document has words and the table items, however
    often a window occurs. ``matches`` lists (item, start, length, exact): a window of ``size`` consecutive words of the
    item (the whole item, if it has fewer) that occurs at word ``start`` of the document, exactly
    or with every word at most ``slop`` places off. Items without words match nothing.

    Items are searched in passes of bounded size, so what is sent to the workers is bounded too;
    the passes' matches are put together by document.
    """
    spark = index.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    id_kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = T._parse_datatype_string(
        f"shard long, nr long, id {id_kind}, n_words long, spans {SPANS}, items array<{kind}>"
        + (f", matches {MATCH.format(item=kind)}" if every else ""))
    target = arrow_schema(T.StructType([*schema.fields[:2], *schema.fields[3:]]))
    told = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("t"))
    count, chars = told.agg(F.count(F.lit(1)), F.sum(F.length("t"))).first()
    passes = max(1, -(-count // PASS_ITEMS), -(-(chars or 0) // PASS_CHARS))
    stored = staged(told.withColumn("p", F.pmod(F.xxhash64("item", "t"), F.lit(passes))), "items")

    def one(p: int) -> DataFrame:
        pool = [(r["item"], r["t"]) for r in stored.filter(F.col("p") == p).select("item", "t").collect()]
        phrases, lengths, owners = phrases_of(pool, size)
        wanted = np.unique(phrases[np.arange(phrases.shape[1]) < lengths[:, None]])
        seen = corpus_frequencies(index, wanted)
        counts = np.array([seen.get(int(t), 0) for t in wanted], np.int64)
        inside = np.arange(phrases.shape[1]) < lengths[:, None]
        where = np.minimum(np.searchsorted(wanted, phrases), max(len(wanted) - 1, 0))
        frequency = np.where(inside, counts[where] if len(wanted) else 0, np.iinfo(np.int64).max)
        possible = (frequency > 0).all(1)
        order = np.argsort(frequency, axis=1, kind="stable")
        held = spark.sparkContext.broadcast((
            phrases[possible], lengths[possible], order[possible],
            [o for o, ok in zip(owners, possible) if ok]))

        def run(batches):
            phrases, lengths, order, owners = held.value
            inside = np.arange(size) < lengths[:, None]
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard(row)
                    k = len(shard.ids)
                    matches, found = [[] for _ in shard.ids], [set() for _ in shard.ids]
                    edges = np.zeros(int(shard.base[-1] + shard.n_words[-1]) + 1 if k else 1, np.int32)
                    numbers = shard.find(phrases)
                    for r in np.flatnonzero(((numbers >= 0) | ~inside).all(1)):
                        n = int(lengths[r])
                        starts, off = intersect(shard, numbers[r], order[r][:n], slop)
                        if not len(starts):
                            continue
                        doc = np.searchsorted(shard.base, starts, side="right") - 1
                        exact = starts[off == 0]
                        np.add.at(edges, exact, 1)
                        np.add.at(edges, exact + n, -1)
                        for d in np.unique(doc[off == 0]).tolist():
                            found[d].update(owners[r])
                        if not every:
                            continue
                        for s, o, d in zip(starts.tolist(), off.tolist(), doc.tolist()):
                            s -= int(shard.base[d])
                            # A near phrase may hang over an end of its document by the slop.
                            if o == 0 or 0 <= s and s + n <= shard.n_words[d]:
                                matches[d] += [{"item": i, "start": s, "length": n, "exact": o == 0}
                                               for i in owners[r]]
                    # Gaps between documents keep their spans apart.
                    turns = np.flatnonzero(np.diff(np.r_[False, np.cumsum(edges) > 0, False])).reshape(-1, 2)
                    spans = [[] for _ in shard.ids]
                    for d, a, b in zip((np.searchsorted(shard.base, turns[:, 0], side="right") - 1).tolist(), *turns.T.tolist()):
                        spans[d].append({"start": a - int(shard.base[d]), "length": b - a})
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["shard"]] * k, pa.int64()), pa.array(range(k), pa.int64()),
                        pa.array(shard.ids, batch.schema.field("ids").type.value_type), pa.array(shard.n_words),
                        *[pa.array(x, target.field(c).type) for x, c in (
                            (spans, "spans"), ([list(x) for x in found], "items"), (matches, "matches")) if c in schema.names]],
                        names=schema.names)

        return index.mapInArrow(run, schema)

    found = one(0)
    for p in range(1, passes):
        found = found.union(one(p))
    if passes > 1:
        found = found.groupBy("shard", "nr").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"),
            united(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            *([F.flatten(F.collect_list("matches")).alias("matches")] if every else []))
    return found.drop("shard", "nr")


def united(spans: Column) -> Column:
    """Spans of several passes, merged where they touch."""
    one = lambda a, n: F.struct(a.alias("start"), n.alias("length"))

    def joined(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        end = last["start"] + last["length"]
        longer = one(last["start"], F.greatest(end, s["start"] + s["length"]) - last["start"])
        return F.when((F.size(done) == 0) | (s["start"] > end), F.concat(done, F.array(one(s["start"], s["length"])))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), joined)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", size: int = 10, slop: int = 0,
                  every: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, spans, n_hit, items, contaminated (and matches, see
    ``search``, if ``every`` one is wanted).

    ``spans`` are the stretches inside exact occurrences, ``n_hit`` counts their words, ``items`` lists, sorted
    as strings, the items with one. Null and wordless texts have no words and no match; null ids are kept, a null
    item id takes part in ``n_hit`` but not in ``items``. Repeated rows come back as often; either
    table may be empty. Other columns are not read.
    """
    index = build_index(docs, id_col, text_col, gap=max(64, size + 2 * slop))
    found = search(index, items, item_col, item_text, size, slop, every)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(
        F.col("id").alias(id_col), "n_words", "spans", hit.alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform(F.array_compact("items"), lambda i: i.cast("string")))).alias("items"),
        *(["matches"] if every else [])).withColumn("contaminated", F.col("n_hit") > 0)
