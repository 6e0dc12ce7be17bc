"""Language identification: nearest clustered centroid over TF-IDF n-gram vectors, with rejection.

Texts become unit vectors of hashed letter n-grams (one to three letters, lower-cased, other
characters as one blank). Every language gets several centroids by spherical k-means; a text takes
the language of the nearest one by cosine and is rejected when it lies further from it than that
language's texts of its length do. Those distances come from all labelled rows, of any length.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.llm.base import sent, slices, text_map

BUCKETS = 4096
# Multipliers of the n-gram hash: fixed odd numbers, any would do.
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
BANDS = 32
# Distances are counted in so many steps of equal width; a band needs so many texts to speak for itself.
STEPS, ENOUGH = 1000, 20


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray          # BUCKETS
    centroids: np.ndarray    # (language and cluster) x BUCKETS, unit rows
    owner: np.ndarray        # language of each centroid
    radius: np.ndarray       # language x length band: largest distance accepted


class Letters:
    """Code points of a text, lower-cased, with every run of other characters as one blank."""

    def __init__(self):
        self.known = np.array([chr(c).isalpha() for c in range(0x3000)])

    def __call__(self, text: str) -> np.ndarray:
        cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
        if not len(cp):
            return cp
        if int(cp.max()) >= len(self.known):
            self.known = np.array([chr(c).isalpha() for c in range(0x110000)])
        is_letter = self.known[cp]
        if not is_letter.any():
            return cp[:0]
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        return np.where(is_letter, cp, 32).astype(np.uint32)[keep]


def counts(cp: np.ndarray) -> np.ndarray:
    """How often each bucket's n-grams occur in the letters of one text."""
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    a = cp * np.uint32(MIX[0])
    grams = [a]
    if len(cp) > 1:
        two = (a[:-1] ^ (cp[1:] * np.uint32(MIX[1]))) * np.uint32(MIX[2])
        grams.append(two)
        if len(cp) > 2:
            grams.append((two[:-1] ^ (cp[2:] * np.uint32(MIX[0]))) * np.uint32(MIX[1]))
    return np.bincount(np.concatenate([g >> shift for g in grams]), minlength=BUCKETS)


def weighted(v: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows from rows of counts, in place."""
    np.log1p(v, out=v)
    v *= idf
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.maximum(n, 1e-9)


def vectors(letters: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    v = np.zeros((len(letters), BUCKETS), np.float32)
    for i, cp in enumerate(letters):
        if len(cp):
            v[i] = counts(cp)
    return weighted(v, idf)


def band(cp: np.ndarray) -> int:
    return min(len(cp).bit_length(), BANDS - 1)


def spread(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from texts far from each other."""
    picked = [int(np.argmax(v @ v.mean(0)))]
    nearest = v @ v[picked[0]]
    while len(picked) < min(k, len(v)):
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, v @ v[picked[-1]])
    c = v[picked]
    for _ in range(rounds):
        who = np.argmax(v @ c.T, axis=1)
        c = np.stack([v[who == j].sum(0) if (who == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c.astype(np.float32)


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """Texts with letters, and in how many of them each bucket occurs; over all rows."""

    def run(batches):
        letters, df, n = Letters(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in slices(batch, 0):
                for x in part.column(0).to_pylist():
                    cp = letters(x or "")
                    if len(cp):
                        df += counts(cp) > 0
                        n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BUCKETS)), pa.array(np.concatenate([[n], df]))], names=["b", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, "b long, n long")
    got = {r["b"]: r["n"] for r in rows.groupBy("b").agg(F.sum("n").alias("n")).collect()}
    return got.get(-1, 0), np.array([got.get(b, 0) for b in range(BUCKETS)], np.float64)


def sampled_counts(rows: DataFrame) -> DataFrame:
    """l, n letters and packed n-gram counts of each text with letters; ``rows`` has t, l, h."""

    def run(batches):
        letters = Letters()
        for batch in batches:
            for part in slices(batch, 0):
                out = []
                for t, name, h in zip(*(part.column(i).to_pylist() for i in range(3))):
                    cp = letters(t or "")
                    if len(cp):
                        c = counts(cp).astype("<u4").tobytes()
                        out.append((name, h, len(cp), zlib.crc32(c), zlib.compress(c, 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], k) for i, k in enumerate(
                        (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["l", "h", "n", "crc", "c"])

    return rows.select("t", "l", "h").mapInArrow(run, "l string, h double, n long, crc long, c binary")


def distances(labelled: DataFrame, model: Model) -> np.ndarray:
    """How many texts lie in each step of distance from the nearest centroid of their own language:
    language x band x STEPS. All rows count, whatever their length."""
    held = sent(labelled.sparkSession, model)

    def run(batches):
        m, letters = held(), Letters()
        at = {name: i for i, name in enumerate(m.languages)}
        own = [np.flatnonzero(m.owner == i) for i in range(len(m.languages))]
        seen = np.zeros((len(m.languages), BANDS, STEPS), np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                told = [(letters(t or ""), at.get(name)) for t, name in zip(
                    *(part.column(i).to_pylist() for i in range(2)))]
                told = [(cp, i) for cp, i in told if len(cp) and i is not None]
                for k in range(0, len(told), 256):
                    some = told[k:k + 256]
                    near = vectors([cp for cp, _ in some], m.idf) @ m.centroids.T
                    for (cp, i), row in zip(some, near):
                        d = 1 - float(row[own[i]].max())
                        seen[i, band(cp), min(STEPS - 1, max(0, int(d * STEPS)))] += 1
        i, b, d = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (i, b, d, seen[i, b, d])], names=["i", "b", "d", "n"])

    out = np.zeros((len(model.languages), BANDS, STEPS), np.int64)
    rows = labelled.select("t", "l").mapInArrow(run, "i long, b long, d long, n long")
    for r in rows.groupBy("i", "b", "d").agg(F.sum("n").alias("n")).collect():
        out[r["i"], r["b"], r["d"]] = r["n"]
    return out


def quantile(seen: np.ndarray, share: float) -> float:
    """Upper end of the step in which ``share`` of the counted distances is reached."""
    total = np.cumsum(seen)
    return (int(np.searchsorted(total, share * total[-1])) + 1) / STEPS


def lengthened(c: np.ndarray, letters: np.ndarray, b: int, rng) -> np.ndarray:
    """Counts of texts of band ``b`` put together from all texts of one language, from few, and from one."""
    times = -(-3 * 2 ** b // 4) / max(1.0, letters.mean())  # a band's middle, in texts
    out = []
    for few in (len(c), 8, 1) * 12:
        some = rng.choice(len(c), min(few, len(c)), replace=False)
        w = rng.multinomial(max(1, round(times / 2)), np.full(len(some), 1 / len(some)))
        out.append(w.astype(np.float32) @ c[some])
    return np.stack(out)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", clusters: int = 4,
        rows_per_language: int = 1500, slack: float = 0.08, share: float = 0.999) -> Model | None:
    """Learns from the rows of ``docs`` with a language; None if there are none with letters.

    Document frequencies and radii count all rows: a band's radius is the distance that ``share`` of
    a language's texts of that length keep to, and ``slack``. Centroids are fitted on a bounded
    sample, about ``rows_per_language`` rows of each language, picked by a hash of the text. Bands
    longer than what is labelled are measured on texts put together from the sample.
    """
    labelled = docs.filter(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l"))
    n, df = document_frequencies(labelled, "t")
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # Equal texts share a hash; so the sample holds each text once.
    h = F.pmod(F.xxhash64("t"), F.lit(1 << 40)) / float(1 << 40)
    # One row per language, as the model has: small enough to send with the model's other parts.
    sizes = labelled.groupBy("l").agg(F.count(F.lit(1)).alias("n"))
    picked = (labelled.withColumn("h", h).join(F.broadcast(sizes), "l")
              .filter(F.col("h") * F.col("n") < rows_per_language))
    by_lang: dict[str, list] = {}
    for r in sampled_counts(picked).dropDuplicates(["l", "h", "n", "crc"]).orderBy("l", "h", "n", "crc").collect():
        by_lang.setdefault(r["l"], []).append((r["n"], bytes(r["c"])))
    languages = sorted(by_lang)
    if not languages:
        return None
    centroids, owner, longer = [], [], []
    for i, name in enumerate(languages):
        sizes = np.array([x for x, _ in by_lang[name]], np.float64)
        c = np.stack([np.frombuffer(zlib.decompress(x), "<u4") for _, x in by_lang.pop(name)]).astype(np.float32)
        near = spread(weighted(c.copy(), idf), clusters)
        centroids.append(near)
        owner += [i] * len(near)
        rng, mine = np.random.default_rng(i), np.array([int(x).bit_length() for x in sizes])
        longer.append([float((1 - (weighted(lengthened(c, sizes, b, rng), idf) @ near.T).max(1)).max())
                       if b > mine.min() and (mine == b).sum() < ENOUGH else 0.0 for b in range(BANDS)])
    model = Model(languages, idf, np.concatenate(centroids), np.array(owner),
                  np.ones((len(languages), BANDS), np.float32))
    seen = distances(labelled, model)
    for i in range(len(languages)):
        full = [b for b in range(BANDS) if seen[i, b].sum() >= ENOUGH]
        for b in range(BANDS):
            if b in full:
                model.radius[i, b] = quantile(seen[i, b], share) + slack
            elif full and b > full[0]:
                # Few texts of this length: what shorter ones, all of these, and lengthened ones reach.
                reach = max(longer[i][b], quantile(seen[i, b], share) if seen[i, b].any() else 0.0)
                model.radius[i, b] = max(reach + slack, model.radius[i, b - 1])
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None
            ) -> DataFrame:
    """Adds lang_pred string, score double (cosine with the nearest centroid), rejected boolean.

    A null or letterless text is ``und`` with score 0 and rejected. Without a model every text is
    ``und`` with score 0, and only such texts are rejected: there is nothing to be far from. Ties go to the language first in alphabetical order. Whole texts are read. Repeated
    rows each get the same answer; an empty table gives no rows. Columns named like a result are
    replaced. ``keep`` names the columns that go along, all by default.
    """
    held = sent(docs.sparkSession, model)

    def make():
        m, letters = held(), Letters()

        def f(texts: list[str]):
            cps = [letters(x) for x in texts]
            if m is None:
                return [["und"] * len(cps), [0.0] * len(cps), [not len(cp) for cp in cps]]
            names, scores, rejected = [], [], []
            for at in range(0, len(cps), 256):
                some = cps[at:at + 256]
                near = vectors(some, m.idf) @ m.centroids.T
                best = near.argmax(1)
                for cp, j, row in zip(some, best, near):
                    who, cos = int(m.owner[j]), min(1.0, max(0.0, float(row[j])))
                    names.append(m.languages[who] if len(cp) else "und")
                    scores.append(cos if len(cp) else 0.0)
                    rejected.append(not len(cp) or 1 - cos > float(m.radius[who, band(cp)]))
            return [names, scores, rejected]

        return f

    return text_map(docs, text, "lang_pred string, score double, rejected boolean", make, keep)


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text is not rejected, with their columns as they were. If no row has a language,
    those that hold a letter."""
    model = fit(docs, text, lang)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    found = predict(docs.toDF(*names), model, names[at])
    return found.filter(~F.col("rejected")).select(
        [F.col(n).alias(c) for n, c in zip(names, docs.columns)])
