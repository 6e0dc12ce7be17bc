"""Prefix trie of conversations by collapsing whole sequences.

Conversations that hold the same turns become one weighted sequence with the list of those that
end there. Sequences that are proper prefixes of others go by an anti-join; what is left are the leaves.
The prefixes of the weighted sequences, added up, are the nodes. A sequence, and so a node, is named
by a 128-bit hash chained over its turns; texts are read once, where they lie, and never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despensa.llm.base import staged

# Ids joined into one piece of an end list.
IDS = 50_000
ROOT = b"\0" * 16
WORD = r"[^\x20\x09-\x0D]+"


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """Columns conv_id, i (from 1, by turn, null first), digest (of role and text), words (of the text).

    Turns with the same number follow by role, then by hash of the text; a row that is there twice
    is two turns. A null role or text is empty. Rows without a conv_id belong to no conversation.
    """
    told = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    slim = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), told(role).alias("role"),
        F.substring(F.unhex(F.sha2(F.concat(F.length(told(role)).cast("string"), F.lit(":"), told(role), told(text)), 256)),
                    1, 16).alias("digest"),
        F.regexp_count(told(text), F.lit(WORD)).cast("long").alias("words"),
    ).filter(F.col("conv_id").isNotNull())
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return slim.select("conv_id", F.row_number().over(order).alias("i"), "digest", "words")


def with_starts(turns: DataFrame) -> DataFrame:
    """Adds a row i = 0 for every conversation, so that one without turns left stays one."""
    start = turns.filter("i = 1").select(
        "conv_id", F.lit(0).alias("i"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return turns.unionByName(start)


def own_head(conv_id: Column, most: int) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (most + 1)).cast("int")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """Turns of rebuilt conversations: the first h of the conversation whose id is the next lower
    multiple of ``group`` (all of them if it has fewer, none if it is not there), then what follows
    the conversation's own first h. h is the id's crc32 modulo ``most`` + 1. Start rows come along.
    """
    turns = staged(turns, "turns")
    h = own_head(F.col("conv_id"), most)
    heads = turns.filter((F.col("i") <= most) & (F.col("conv_id") % group == 0)).groupBy("conv_id").agg(
        F.collect_list(F.struct("i", "digest", "words")).alias("head"))  # at most ``most`` turns
    of = F.col("conv_id") - F.col("conv_id") % group
    taken = (
        turns.filter("i = 1").filter(h > 0).select("conv_id", of.alias("base"), h.alias("h"))
        .join(heads.withColumnRenamed("conv_id", "base"), "base")
        .select("conv_id", "h", F.inline("head")).filter("i <= h").drop("h")
    )
    own = with_starts(turns).filter((F.col("i") == 0) | (F.col("i") > h))
    return own.unionByName(taken.select(own.columns))


def chained(turns: DataFrame) -> DataFrame:
    """A row for every prefix of every conversation: conv_id, depth, key, parent, words, whole (the
    conversation ends there). One sorted stream a task, whose state is a single hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv, i, digest, words in zip(*[c.to_pylist() for c in batch.columns]):
                if held is not None:
                    out.append((*held, i == 0))
                if i == 0:
                    held = (conv, 0, ROOT, None, 0)
                else:
                    held = (conv, held[1] + 1, hashlib.sha256(held[2] + digest).digest()[:16], held[2], words)
            if out:
                yield table(out)
        if held is not None:
            yield table([(*held, True)])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
            names=["conv_id", "depth", "key", "parent", "words", "whole"])

    ordered = turns.select("conv_id", "i", "digest", "words").repartition("conv_id").sortWithinPartitions("conv_id", "i")
    return ordered.mapInArrow(run, "conv_id long, depth long, key binary, parent binary, words long, whole boolean")


def end_lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each key, ascending and comma-joined, from rows (key, conv_id).

    Ids are sorted by range over all tasks, so those of one key lie in many, and joined piece by
    piece; one task then hashes the pieces of a key one after the other and holds one at a time.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                names=["key", "first", "ids"])

        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) == IDS):
                    yield piece()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if h is not None:
                        out.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if out:
                yield rows(out)
        if h is not None:
            yield rows([(key, h.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], pa.binary()), pa.array([x for _, x in out])], names=["key", "ends_sha256"])

    pieces = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions(
        "key", "conv_id").mapInArrow(joined, "key binary, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends_sha256 string")


def sequences(prefixes: DataFrame) -> DataFrame:
    """The distinct whole sequences of ``chained`` rows: key, rep (smallest conv_id), weight."""
    return prefixes.filter("whole").groupBy("key").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations given as rows (conv_id, i, digest, words) with start rows.

    Columns conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and key and parent, the hashes that name node and parent.
    The root has depth 0 and no text; every conversation, also one without turns, is its member.
    No conversations, no nodes. Conversations with the same turns are members of the same nodes.

    A node belongs to the leaf with the smallest id below it, so what is summed over a subtree is
    summed once along each leaf, from its end, and then over the leaves of the node: the work grows
    with the turns of distinct sequences, not with their square.
    """
    chain = staged(chained(turns), "chain")
    whole = sequences(chain)
    prefixes = staged(
        chain.join(whole.select(F.col("rep").alias("conv_id"), "weight"), "conv_id").withColumnRenamed("conv_id", "rep"),
        "prefixes")
    proper = prefixes.filter(~F.col("whole")).select("key").distinct()
    leaves = prefixes.filter("whole").join(proper, "key", "left_anti").select("rep", F.lit(True).alias("leaf"))
    leaves = staged(leaves, "leaves")
    nodes = staged(
        prefixes.join(leaves, "rep", "left")
        .groupBy("key", "parent", "depth", "words").agg(
            F.sum("weight").alias("n_convs"), F.min("rep").alias("conv_id"),
            F.count("leaf").alias("n_leaves"), F.min(F.when(F.col("leaf"), F.col("rep"))).alias("owner")), "nodes")
    own = nodes.select(F.col("owner").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    below = Window.partitionBy("rep").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    saved = (
        prefixes.join(leaves, "rep", "left_semi").select("rep", "depth", "key").join(own, ["rep", "depth"], "left")
        .withColumn("s", F.sum(F.coalesce("own", F.lit(0))).over(below))
        .groupBy("key").agg(F.sum("s").alias("saved_tokens"))
    )
    children = nodes.filter(F.col("parent").isNotNull()).groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    ends = end_lists(chain.filter("whole"))
    up = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    told = (
        nodes.join(saved, "key")
        .join(children.withColumnRenamed("parent", "key"), "key", "left")
        .join(ends, "key", "left")
        .join(up, "parent", "left")
    )
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "key", "parent")
