import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from despensa.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, digest string, i string, depth string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    """Trie of the rebuilt conversations by its definition."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, digest(role, text), text))
    own = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        seq = tuple(base[:h] + turns[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        words = len(re.findall("[^ \t-\r]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * words
    return sorted(
        (min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node], leaves[node],
         saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, of in members.items())


def trie(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = conversations.prefix_trie(conversations.rebuilt(conversations.turns_of(df)))
    return sorted(tuple(r)[:8] for r in got.collect())


def planted(seed, convs, turns):
    rng = random.Random(seed)
    return [(c, t, "user" if t % 2 == 0 else "assistant", f"w{rng.randint(0, 1)} " * rng.randint(0, 2))
            for c in range(convs) for t in range(rng.randint(1, turns))]


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(spark, seed):
    rows = planted(seed, 120, 5)
    assert trie(spark, rows) == brute(rows)


def test_long_and_common_conversations(spark, monkeypatch):
    """Hundreds of turns, a conversation a third of all share, one that is a prefix of another."""
    monkeypatch.setattr(conversations, "IDS", 7)
    rows = [(1000, t, "user", f"turn {t}") for t in range(300)]
    rows += [(1001 + k, t, "user", f"turn {t}") for k in range(60) for t in range(3)]
    rows += [(2000, t, "user", f"turn {t}") for t in range(299)]
    assert trie(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (None, None, None, None), (40, None, None, None), (40, None, "user", "null turn first"),
            (40, 0, None, "a"), (40, 1, "user", None), (41, 0, "user", ""), (41, 0, "user", ""), (41, 0, "assistant", "tie"),
            (63, 5, "user", "word " * 50_000), (64, 1, "a", "b"), (65, 1, "ab", ""), (-3, 0, "user", "below zero"),
            (-20, 0, "user", "base below zero"), (2**62, 0, "user", "日本\x0bx"), (60, 0, "user", "x")]
    rows += [(c, 0, "user", "turnless once its head is cut") for c in range(100, 120) if c != 100]
    assert trie(spark, rows) == brute(rows)
    assert trie(spark, []) == []


def test_sequences_and_ends(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "u", "b")]
    turns = conversations.with_starts(conversations.turns_of(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = conversations.sequences(conversations.chained(turns)).select("rep", "weight").collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 1)]
    nodes = {r["depth"]: r for r in conversations.prefix_trie(turns).collect()}
    assert [nodes[d]["n_convs"] for d in range(3)] == [3, 3, 2]
    assert [nodes[d]["saved_tokens"] for d in range(3)] == [3, 3, 1]
    assert nodes[1]["ends_sha256"] == hashlib.sha256(b"2").hexdigest()
