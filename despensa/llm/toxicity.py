"""Toxicity: a convolutional text classifier in numpy, trained on all labelled rows in shards, with
thresholds calibrated by language.

A word's vector is the sum of hashed embeddings of the word, its first four and five letters and
its last three. Filters one, two and three words wide run over the whole text, each filter's
largest answer is kept, and a linear layer gives the logit. The language that calibrates a
threshold is found from the text, by the nearest-centroid operator.
"""

from __future__ import annotations

import copy
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.llm import langid
from despensa.llm.base import Known, sent, staged, text_map

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 16, (1, 2, 3)
AT_ONCE = 100_000  # words a batch of several texts may hold
# Shards that the net is trained on: texts, and their characters. Blocks its vectors are averaged in.
SHARD_ROWS, SHARD_CHARS, BLOCKS = 3000, 24_000_000, 32
ROUNDS = 2  # in which the shards learn and are averaged
# Steps of a logit in which the thresholds' counts are kept; logits beyond the bound count as it.
STEP, BOUND = 1000, 30.0
GAP = max(WIDTHS)  # empty places behind each text, so that no window reaches the next one
# The score at which the threshold of every language is put.
DECISION = 0.7
LETTERS = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Buckets of a word; bucket 0 is the empty place."""
    return [1 + zlib.crc32(x.encode()) % (BUCKETS - 1)
            for x in ("=" + word, "4" + word[:4], "5" + word[:5], "3" + word[-3:])]


class Words:
    """Numbers of the words of a text; ``table`` holds each number's buckets. Bounded, like any
    memory that only saves time: it starts anew when it is full."""

    FULL = 300_000

    def __init__(self):
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.rows: list[list[int]] = [[0] * 4]
        self.piece = Known(self._piece, self.FULL)

    def _piece(self, piece: str) -> bytes:
        out = []
        for w in LETTERS.findall(piece):
            n = self.number.get(w)
            if n is None:
                n = self.number[w] = len(self.rows)
                self.rows.append(features(w))
            out.append(n)
        return np.array(out, "<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.piece.__getitem__, text.lower().split())), "<u4")


def lay_out(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words behind each other with gaps; bounds (start, end, start, end, ...)."""
    empty = np.zeros(GAP, np.uint32)
    flat = np.concatenate([x for n in numbers for x in (n, empty)])
    sizes = np.array([len(n) for n in numbers])
    starts = np.concatenate([[0], np.cumsum(sizes + GAP)[:-1]])
    return flat, np.stack([starts, starts + np.maximum(sizes, 1)], 1).reshape(-1)


@dataclass
class Net:
    embedding: np.ndarray        # BUCKETS x DIM, row 0 zero
    filters: np.ndarray          # DIM x (place of every width, filter)
    bias: np.ndarray             # width x filter
    out: np.ndarray              # width x filter
    out_bias: float

    def answers(self, x: np.ndarray) -> np.ndarray:
        """Answers of all filters at every place: (width, filter) x places."""
        y = self.filters.T @ x.T
        found, at = np.empty((FILTERS * len(WIDTHS), len(x)), np.float32), 0
        for i, w in enumerate(WIDTHS):
            total = found[i * FILTERS:(i + 1) * FILTERS]
            total[:] = y[at:at + FILTERS]
            for j in range(1, w):
                total[:, :-j] += y[at + j * FILTERS:at + (j + 1) * FILTERS, j:]
            at += w * FILTERS
        return found

    def logits(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        # reduceat takes what lies between two bounds; every second part is a gap.
        top = np.maximum.reduceat(self.answers(x), bounds, axis=1)[:, ::2]
        return np.maximum(top.T + self.bias, 0) @ self.out + self.out_bias


def batches_of(sizes: list[int], batch: int) -> list[np.ndarray]:
    """Texts of like length together, up to ``batch`` of them and, if more than one, AT_ONCE words."""
    by_size, out = np.argsort(sizes, kind="stable"), []
    start, held = 0, 0
    for i, k in enumerate(by_size):
        if i > start and (i - start >= batch or held + sizes[k] > AT_ONCE):
            out.append(by_size[start:i])
            start, held = i, 0
        held += sizes[k]
    return [*out, by_size[start:]] if len(by_size) > start else out


def train(texts: list[str], labels: list[int], epochs: int = 4, batch: int = 32, rate: float = 0.01,
          seed: int = 42, steps: int = 500, weights: list[float] | None = None, start: Net | None = None) -> Net:
    """Fits the net with Adam in ``epochs`` passes, more where they make fewer than ``steps`` steps;
    the same input gives the same net. ``weights`` says how much a text counts, ``start`` is a net to go
    on from."""
    rng = np.random.default_rng(seed)
    n = FILTERS * len(WIDTHS)
    # Small vectors at first: a word that training never moved stays without influence.
    net = copy.deepcopy(start) if start else Net(rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32),
              rng.normal(0, 0.3, (DIM, FILTERS * sum(WIDTHS))).astype(np.float32),
              np.zeros(n, np.float32), rng.normal(0, 0.1, n).astype(np.float32), 0.0)
    net.embedding[0] = 0
    words = Words()
    words.FULL = 1 << 62
    numbers = [words(t) for t in texts]
    table = np.array(words.rows, np.int64)
    y = np.array(labels, np.float32)
    weight = np.ones(len(y), np.float32) if weights is None else np.array(weights, np.float32)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in
             (("embedding", net.embedding), ("filters", net.filters), ("bias", net.bias), ("out", net.out))}
    bias_state = [0.0, 0.0]

    def adam(name: str, grad: np.ndarray, rows=None):
        m, v = state[name]
        p, at = getattr(net, name), slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad * grad
        p[at] -= rate * m[at] / (np.sqrt(v[at]) + 1e-6)

    order = batches_of([len(x) for x in numbers], batch)
    epochs = max(epochs, -(-steps // max(1, -(-len(texts) // batch))))
    for _ in range(epochs):
        # Batches of texts of like length in random order: memory stays even.
        for b in rng.permutation(len(order)):
            some = order[b]
            flat, bounds = lay_out([numbers[i] for i in some])
            buckets = table[flat]
            x = net.embedding[buckets].sum(1)
            found = net.answers(x)
            top, where = np.empty((len(some), n), np.float32), np.empty((len(some), n), np.int64)
            for k in range(len(some)):
                part = found[:, bounds[2 * k]:bounds[2 * k + 1]]
                where[k] = part.argmax(1)
                top[k] = part[np.arange(n), where[k]]
                where[k] += bounds[2 * k]
            hidden = np.maximum(top + net.bias, 0)
            z = hidden @ net.out + net.out_bias
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) * weight[some] / len(some)
            back = error[:, None] * net.out * (hidden > 0)  # texts x filters
            d_filters, places, d_x, at = np.zeros_like(net.filters), [], [], 0
            for i, w in enumerate(WIDTHS):
                g, p = back[:, i * FILTERS:(i + 1) * FILTERS], where[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(w):
                    cols = slice(at + j * FILTERS, at + (j + 1) * FILTERS)
                    q = np.minimum(p + j, len(x) - 1)
                    d_filters[:, cols] = np.einsum("tfd,tf->df", x[q], g)
                    places.append(q.reshape(-1))
                    d_x.append((g[:, :, None] * net.filters[:, cols].T).reshape(-1, DIM))
                at += w * FILTERS
            rows, back_to = np.unique(buckets[np.concatenate(places)].reshape(-1), return_inverse=True)
            d_rows = np.zeros((len(rows), DIM), np.float32)
            np.add.at(d_rows, back_to.reshape(-1), np.repeat(np.concatenate(d_x), 4, axis=0))
            if len(rows) and rows[0] == 0:
                d_rows[0] = 0
            adam("embedding", d_rows, rows)
            adam("filters", d_filters)
            adam("bias", back.sum(0))
            adam("out", error @ hidden)
            bias_state[0] = 0.9 * bias_state[0] + 0.1 * float(error.sum())
            bias_state[1] = 0.99 * bias_state[1] + 0.01 * float(error.sum()) ** 2
            net.out_bias -= rate * bias_state[0] / (bias_state[1] ** 0.5 + 1e-6)
            net.embedding[0] = 0
    return net


class Scorer:
    """Logits of texts under a net; keeps the vectors of words seen before."""

    def __init__(self, net: Net):
        self.net, self.words = net, Words()
        self.vectors = np.zeros((1, DIM), np.float32)

    def __call__(self, texts: list[str], at_once: int = 100_000) -> np.ndarray:
        if len(self.words.rows) > self.words.FULL:
            self.words.clear()
            self.vectors = self.vectors[:1]
        numbers = [self.words(t) for t in texts]
        new = self.words.rows[len(self.vectors):]
        if new:
            self.vectors = np.concatenate([self.vectors, self.net.embedding[np.array(new)].sum(1)])
        out, group, held = [], [], 0
        for n in [*numbers, None]:
            if group and (n is None or held + len(n) > at_once):
                out.append(self.part(group))
                group, held = [], 0
            if n is not None:
                group.append(n)
                held += len(n)
        return np.concatenate(out) if out else np.zeros(0)

    def part(self, numbers: list[np.ndarray]) -> np.ndarray:
        flat, bounds = lay_out(numbers)
        return self.net.logits(self.vectors[flat], bounds)


@dataclass
class Model:
    net: Net | None
    languages: langid.Model | None
    shift: dict[str, float]  # logit of each language's threshold; "" for all others


def best_threshold(logits: np.ndarray, ones: np.ndarray, all_of: np.ndarray) -> float:
    """The logit that parts the labels with the best F1, half way to its neighbours. For each distinct
    logit, how many texts have it and how many of these are marked 1."""
    order = np.argsort(-logits, kind="stable")
    z, y = logits[order], ones[order]
    f1 = 2 * np.cumsum(y) / (np.cumsum(all_of[order]) + y.sum())
    i = int(f1.argmax())
    return float(z[i] + z[i + 1]) / 2 if i + 1 < len(z) else float(z[i]) - 1.0


PARTS = ("filters", "bias", "out", "out_bias")


def trained(shards: DataFrame, start: Net | None, rate: float, **how) -> DataFrame:
    """block, shard, delta, moved: what training on each shard by itself, from ``start``, changes in each
    block of the word vectors and in the other parameters (block -1), and which vectors it moved."""
    held = sent(shards.sparkSession, start)

    def run(key, rows):
        begun = held()
        d = rows.select(["t", "y", "w", "id", "n"]).sort_by([("id", "ascending"), ("t", "ascending")]).to_pydict()
        net = train(d["t"], d["y"], weights=[w * n for w, n in zip(d["w"], d["n"])], start=begun, rate=rate, **how)
        base = begun or Net(*[np.zeros_like(getattr(net, k)) for k in ("embedding", *PARTS)])
        change = net.embedding - base.embedding
        moved = (change != 0).any(1)
        rest = np.concatenate([np.ravel(getattr(net, k) - getattr(base, k)) for k in PARTS]).astype(np.float32)
        out = [(-1, rest.tobytes(), b"")]
        for k, (c, m) in enumerate(zip(np.split(change, BLOCKS), np.split(moved, BLOCKS))):
            out.append((k, c[m].tobytes(), m.tobytes()))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "shard": pa.array([key[0].as_py()] * len(out), pa.int64()),
                         "delta": pa.array([x[1] for x in out], pa.binary()), "moved": pa.array([x[2] for x in out], pa.binary())})

    return shards.groupBy("shard").applyInArrow(run, "block long, shard long, delta binary, moved binary")


def averaged(deltas: DataFrame, start: Net | None) -> Net:
    """The net that goes as far from ``start`` as the shards did in the mean. A word's vector moves by the
    mean of the shards that hold the word: rare ones are not held back by shards without them."""

    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for k, delta, moved in zip(*(batch.column(i).to_pylist() for i in range(3))):
                d = np.frombuffer(delta, np.float32).astype(np.float64)
                if k < 0:
                    s = sums.setdefault(k, [np.zeros(len(d)), np.zeros(1)])
                    s[0] += d
                    s[1] += 1
                    continue
                s = sums.setdefault(k, [np.zeros((BUCKETS // BLOCKS, DIM)), np.zeros((BUCKETS // BLOCKS, 1))])
                m = np.frombuffer(moved, bool)
                s[0][m] += d.reshape(-1, DIM)
                s[1][m] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([(s / np.maximum(n, 1)).astype(np.float32).tobytes()
                                                         for s, n in sums.values()], pa.binary())], names=["block", "mean"])

    # In the order of the shards, so that sums come out alike.
    rows = (deltas.repartition("block").sortWithinPartitions("block", "shard").select("block", "delta", "moved")
            .mapInArrow(run, "block long, mean binary"))
    got = {r["block"]: np.frombuffer(r["mean"], np.float32) for r in rows.collect()}
    n, wide = FILTERS * len(WIDTHS), FILTERS * sum(WIDTHS)
    f, b, o, last = np.split(got[-1], np.cumsum([DIM * wide, n, n]))
    net = Net(np.concatenate([got[k] for k in range(BLOCKS)]).reshape(BUCKETS, DIM), f.reshape(DIM, wide), b, o, float(last[0]))
    if start is not None:
        net = Net(*[getattr(start, k) + getattr(net, k) for k in ("embedding", *PARTS)])
    return net


def thresholds(check: DataFrame, net: Net, languages: langid.Model | None) -> dict[str, float]:
    """The logit of the best F1 over all rows of ``check`` (t, y, n), and over those of each language."""
    held = sent(check.sparkSession, (net, languages))

    def make():
        n, m = held()
        scorer = Scorer(n)
        return lambda texts: [scorer(texts).astype(float).tolist(), languages_of(m, texts)]

    z = F.round(F.least(F.greatest("z", F.lit(-BOUND)), F.lit(BOUND)) * STEP).cast("int").alias("z")
    rows = text_map(check, "t", "z double, who string", make, ["y", "n"]).groupBy("who", z).agg(
        F.sum(F.col("n") * F.col("y")).alias("ones"), F.sum("n").alias("n")).orderBy("who", "z").collect()
    who = np.array([r["who"] for r in rows])
    at, ones, all_of = (np.array([r[k] for r in rows], float) for k in ("z", "ones", "n"))
    # All languages' texts of one logit together.
    every, place = np.unique(at, return_inverse=True)
    shift = {"": best_threshold(every / STEP, np.bincount(place, ones), np.bincount(place, all_of)) if ones.any() else 0.0}
    for name in np.unique(who):
        mine = who == name
        if min(ones[mine].sum(), (all_of - ones)[mine].sum()) >= 10:
            shift[str(name)] = best_threshold(at[mine] / STEP, ones[mine], all_of[mine])
    return shift


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", lang_col: str = "lang") -> Model:
    """Learns from all rows of ``docs`` that ``labels`` marks 0 or 1 (any 1 counts as 1), whole texts.

    A quarter of them, by a hash of the id, is kept from the net and calibrates the thresholds, for each
    language that the centroid model finds in the text. The net is trained on the rest in shards of
    bounded size, both labels with equal weight: from a net of the first shard every shard goes on by
    itself, in ROUNDS, and the mean of what they learned is the next net. One shard is trained on as it is. The
    languages are learned from ``lang_col`` of ``docs``.
    """
    marked = labels.filter(F.col(f"`{label_col}`").isin(0, 1) & F.col(f"`{id_col}`").isNotNull()).groupBy(
        F.col(f"`{id_col}`").alias("id")).agg(F.max(F.col(f"`{label_col}`")).cast("int").alias("y"))
    held = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(
        F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t")).join(marked, "id")
    # Equal rows once, with their number: repeats cannot fill a shard.
    aside = F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 3
    rows = staged(held.groupBy("id", "t", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("aside", aside), "marked")
    seen = {(r["aside"], r["y"]): r for r in rows.groupBy("aside", "y").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.sum(F.length("t")).alias("chars")).collect()}
    if len({y for _, y in seen}) < 2:
        return Model(None, None, {"": 0.0})
    if all(a for a, _ in seen):
        rows, seen = rows.withColumn("aside", F.lit(False)), {(False, y): r for (_, y), r in seen.items()}
    told = {y: r for (a, y), r in seen.items() if not a}
    texts = sum(r["n"] for r in told.values())
    weight = {y: texts / len(told) / r["n"] for y, r in told.items()}
    many = sum(r["rows"] for r in told.values())
    shards = max(1, -(-many // SHARD_ROWS), -(-sum(r["chars"] for r in told.values()) // SHARD_CHARS))
    learn = rows.filter(~F.col("aside")).select(
        "id", "t", "y", "n", F.when(F.col("y") == 1, weight.get(1, 1.0)).otherwise(weight.get(0, 1.0)).alias("w"),
        F.pmod(F.xxhash64("id", "t", F.lit(7)), F.lit(shards)).alias("shard"))
    # The first shard that holds both labels, if any does.
    first = learn.groupBy("shard").agg(F.countDistinct("y").alias("k")).orderBy(F.desc("k"), "shard").first()["shard"]
    net = averaged(trained(learn.filter(F.col("shard") == first), None, 0.01), None)
    for _ in range(ROUNDS if shards > 1 else 0):
        net = averaged(trained(learn, net, 0.01, epochs=1, steps=40), net)
    languages = langid.fit(docs, text_col, lang_col)
    check = rows.filter("aside") if any(a for a, _ in seen) else rows
    return Model(net, languages, thresholds(check, net, languages))


def languages_of(model: langid.Model | None, texts: list[str]) -> list[str]:
    if model is None:
        return [""] * len(texts)
    letters, out = langid.Letters(), []
    for i in range(0, len(texts), 256):
        cps = [letters(t) for t in texts[i:i + 256]]
        best = (langid.vectors(cps, model.idf) @ model.centroids.T).argmax(1)
        out += [model.languages[model.owner[j]] if len(c) else "" for c, j in zip(cps, best)]
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds score double (0 to 1) and predicted int (1 from 0.7 on) for every whole text.

    The score is the net's logit, moved so that the threshold of the text's language lies at 0.7. Null
    and empty texts are scored as texts without words; without a model every score is 0. Nothing
    but the text goes in. Repeated rows get equal scores; an empty table gives no rows. Columns
    named like a result are replaced. ``keep`` names the columns that go along, all by default.
    """
    held = sent(docs.sparkSession, model)
    put = float(np.log(DECISION / (1 - DECISION)))

    def make():
        m = held()
        scorer = Scorer(m.net) if m.net is not None else None

        def f(texts: list[str]):
            if scorer is None:
                return [[0.0] * len(texts), [0] * len(texts)]
            shift = np.array([m.shift.get(x, m.shift[""]) for x in languages_of(m.languages, texts)])
            z = np.clip(scorer(texts) - shift + put, -30, 30)
            # To six places: the last bits depend on which texts are multiplied together.
            s = np.round(1 / (1 + np.exp(-z)), 6)
            return [s.tolist(), (s >= DECISION).astype(int).tolist()]

        return f

    return text_map(docs, text_col, "score double, predicted int", make, keep)
