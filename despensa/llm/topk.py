"""Exact top-k by inner product: columnar branch and bound over blocks of dimensions.

Vectors become whole numbers floor(scale * x). Candidates lie in vertical layout, one array per
block of dimensions; scores add up block by block, and after each block a candidate is dropped for
a query when its score and the largest product its remaining dimensions allow (Cauchy-Schwarz on the
remaining norms) fall below the query's k-th best score so far. What survives is compacted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from despensa.llm.base import staged

# Queries searched in one pass over the candidates (what is sent to every worker), and the sides
# of the score matrix a task holds.
PASS, QUERIES, CANDIDATES, BLOCK = 16_384, 256, 2048, 16
# Below this share of live pairs a matrix becomes a list of pairs.
SPARSE = 0.1


def whole(rows: list, scale: float) -> np.ndarray:
    """floor(scale * x) of vectors of one length, as doubles: exact up to 2^53."""
    return np.floor(scale * np.array(rows, np.float64))


class Columns:
    """Vectors in vertical layout with the norms of what follows each block."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        self.ids = ids
        self.blocks = [np.ascontiguousarray(v[:, i:i + BLOCK]) for i in range(0, v.shape[1], BLOCK)]
        mass = np.array([(b * b).sum(1) for b in self.blocks]).reshape(len(self.blocks), len(v))
        # A little more than the true norms, so that rounding never drops a candidate.
        self.rest = np.sqrt(mass[::-1].cumsum(0)[::-1]) * (1 + 1e-9) + 1e-6


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        return self.score[:, -1]

    def put(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Adds (query, score, id) triples."""
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        top = rank < self.k
        new_s = np.full((len(self.score), self.k), -np.inf)
        new_i = np.full((len(self.score), self.k), np.iinfo(np.int64).max)
        new_s[q[top], rank[top]], new_i[q[top], rank[top]] = score[top], ids[top]
        touched = np.unique(q)
        s = np.concatenate([self.score[touched], new_s[touched]], axis=1)
        i = np.concatenate([self.ids[touched], new_i[touched]], axis=1)
        pick = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[touched] = np.take_along_axis(s, pick, 1)
        self.ids[touched] = np.take_along_axis(i, pick, 1)


def search_block(queries: Columns, rows: Columns, best: Best) -> None:
    """Adds what the candidates ``rows`` have to the best of each query."""
    floor = best.floor()
    n = len(rows.blocks)
    live_c, total = np.arange(len(rows.ids)), np.zeros((len(queries.ids), len(rows.ids)))
    pairs = None
    for b in range(n):
        if pairs is None:
            total += queries.blocks[b] @ rows.blocks[b][live_c].T
        else:
            q, c, s = pairs
            s = s + np.einsum("ij,ij->i", queries.blocks[b][q], rows.blocks[b][c])
            pairs = q, c, s
        if b == n - 1:
            break
        if pairs is None:
            alive = total + queries.rest[b + 1][:, None] * rows.rest[b + 1][live_c] >= floor[:, None]
            share = alive.mean() if alive.size else 0
            if share < SPARSE:
                q, c = np.nonzero(alive)
                pairs = q, live_c[c], total[q, c]
            else:
                some = alive.any(0)
                if not some.all():
                    live_c, total = live_c[some], total[:, some]
        else:
            ok = s + queries.rest[b + 1][q] * rows.rest[b + 1][c] >= floor[q]
            pairs = q[ok], c[ok], s[ok]
    if pairs is None:
        q, c = np.nonzero(total >= floor[:, None])
        pairs = q, live_c[c], total[q, c]
    q, c, s = pairs
    ok = (s >= floor[q]) & (queries.ids[q] != rows.ids[c])
    if ok.any():
        best.put(q[ok], s[ok], rows.ids[c[ok]])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of every query.

    ``queries`` and ``vectors`` have the same columns. Every row is a candidate but those with the
    query's own id; vectors that are null, empty, or hold a null or a number that is not finite,
    and rows without an id, take no part. Vectors of different lengths never meet. Ties go to the
    smaller id. A repeated row is a candidate each time; a repeated query is one query, and an id
    with several vectors as many. Fewer candidates than k give fewer rows, empty tables none.

    Queries are searched in passes of a bounded number, each over all candidates; every task
    returns its k best per query, which are merged by query.
    """
    clean = lambda df: df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v")
    ).filter("id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
             "AND abs(x) < double('Infinity'))")
    rows = clean(vectors)
    # Queries are dealt to passes by hash, so no pass grows with the table.
    wanted = staged(clean(queries).distinct(), "queries")
    passes = max(1, -(-wanted.count() // PASS))
    spark = vectors.sparkSession
    parts = None
    for p in range(passes):
        mine = wanted.filter(F.pmod(F.xxhash64("id", "v"), F.lit(passes)) == p).orderBy("id", "v")
        held = spark.sparkContext.broadcast([(r["id"], np.array(r["v"])) for r in mine.collect()])
        part = rows.mapInArrow(search_all(held, k, scale, p << 32),
                               "query long, query_id long, vec_id long, score long")
        parts = part if parts is None else parts.union(part)
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return parts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def search_all(held, k: int, scale: float, first: int):
    def run(batches: Iterator[pa.RecordBatch], first: int = first) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, list] = {}
        for i, v in held.value:
            by_size.setdefault(len(v), []).append((i, v))
        blocks = {}
        for d, some in by_size.items():
            for at in range(0, len(some), QUERIES):
                part = some[at:at + QUERIES]
                c = Columns(np.array([i for i, _ in part]), whole([v for _, v in part], scale))
                blocks.setdefault(d, []).append((c, Best(len(part), k), first))
                first += len(part)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for d in np.unique(sizes):
                if int(d) not in blocks:
                    continue
                mine = np.flatnonzero(sizes == d)
                for at in range(0, len(mine), CANDIDATES):
                    some = mine[at:at + CANDIDATES]
                    v = flat[(ends[some] - d)[:, None] + np.arange(d)]
                    rows = Columns(ids[some], np.floor(scale * v))
                    for q, best, _ in blocks[int(d)]:
                        search_block(q, rows, best)
        for some in blocks.values():
            for q, best, nr in some:
                at, j = np.nonzero(best.score > -np.inf)
                yield pa.RecordBatch.from_arrays([
                    pa.array(nr + at), pa.array(q.ids[at]), pa.array(best.ids[at, j]),
                    pa.array(best.score[at, j].astype(np.int64))],
                    names=["query", "query_id", "vec_id", "score"])

    return run
