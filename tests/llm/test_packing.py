import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from despensa.llm import packing, tokenfiles
from despensa.llm.base import WordIds, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


TEXTS = ["", " ", "Hello World's <|endoftext|> don't x<|startoftext|>y", "Ünïcödé ½ ³ a²b", "日本語 テスト abc",
         "é é x́ ́", "İstanbul ΣΑΣ ΣΑΣ. ſ", "a b\u0085c\x1cd\x0be f", "I'LL they'RE '" * 3, "x" * 5000,
         "😀👍🏽 ok", "a\tb\r\nc", "ǅ ǆ ß ŉ", "​﻿ zero", "１２ ٣ ⅷ"]


def test_ids_are_the_librarys(tokenizer):
    words = WordIds(tokenizer_path())
    for t in TEXTS * 2:
        assert list(words(t)) == tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("capacity", [1, 8, 64, 2048])
def test_slots(capacity):
    for n in [*range(1, 3 * capacity + 2), 9 * capacity + 7][:5000]:
        cut = packing.slot_lengths(n, capacity, 100)
        assert sum(cut) == n and all(0 < c <= capacity for c in cut)
    assert sum(packing.powers(5 * capacity + 3, capacity)) == 5 * capacity + 3


def check_packed(rows, docs, tokenizer, end, capacity):
    """Each id lies in exactly one piece; sequences are gapless and no longer than the capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] > 0
        by_doc[r["doc_id"]].append((r["start"], ids.tolist(), r["doc_tokens"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in by_seq.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    wanted = defaultdict(list)
    for d, t in docs:
        wanted[d].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [end])
    assert set(wanted) == set(by_doc)
    for d, pieces in by_doc.items():
        if len(wanted[d]) == 1:
            flat = []
            for start, ids, n in sorted(pieces):
                assert start == len(flat) and n == len(wanted[d][0])
                flat += ids
            assert flat == wanted[d][0]
        else:
            assert sum(len(p[1]) for p in pieces) == sum(map(len, wanted[d]))


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(docs_of, odd_rows, tokenizer, capacity):
    rows = odd_rows + [(100 + i, "the cat sat on the mat " * (i * i % 37)) for i in range(60)]
    got = packing.pack(docs_of(rows), capacity=capacity)
    check_packed(got.collect(), rows, tokenizer, 1, capacity)
    p = packing.padding(got, capacity).first()
    assert p["padding"] <= 0.05 * p["ids"]


def test_pack_nothing(docs_of):
    assert packing.pack(docs_of([])).count() == 0


def test_fixed_number_in_a_bin():
    w = packing.Worker(0, 2048, 100)
    for i in range(7):
        w.add(i, np.arange(512, dtype=np.uint32))
    assert [r[0] for r in w.out] == [0, 1, 2, 3] and len(w.open[4]) == 3
    w.end()
    assert sorted({r[4] for r in w.out}) == [0, 1, 2]  # 1536 left: 1024 and 512


def test_coding():
    for a in ([], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], list(range(1000))):
        a = np.array(a, np.uint32)
        control, data = tokenfiles.encode(a)
        assert (tokenfiles.decode(control, data, len(a)) == a).all()
        assert len(control) == -(-len(a) // 4)


def test_files_hold_every_id(spark, docs_of, odd_rows, tokenizer, tmp_path):
    folder = tokenfiles.write_ids(docs_of(odd_rows), str(tmp_path / "ids"))
    got = sorted(tokenfiles.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in odd_rows), key=lambda d: (d is not None, d))
    at = 0
    texts = defaultdict(list)
    for d, t in odd_rows:
        texts[d].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == at and r["n_tokens"] == len(ids)
        assert ids in texts[r["doc_id"]]
        texts[r["doc_id"]].remove(ids)
        at += len(ids)
    assert not any(texts.values())
    ranks = np.frombuffer((tmp_path / "ids" / "ranks.bin").read_bytes(), "<u4")
    counts = np.bincount(np.concatenate([np.frombuffer(bytes(r["ids"]), "<u4") for r in got]))
    assert (np.diff(counts[ranks]) <= 0).all()


def test_files_of_nothing(spark, docs_of, tmp_path):
    folder = tokenfiles.write_ids(docs_of([]), str(tmp_path / "none"))
    assert tokenfiles.read_ids(spark, folder).count() == 0


def test_crc_is_of_the_ids(spark, docs_of, tokenizer):
    from pyspark.sql import functions as F

    row = packing.pack(docs_of([(1, "hello world")])).select(F.crc32("ids").alias("c")).collect()
    ids = np.array(tokenizer.encode("hello world", add_special_tokens=False).ids + [1], "<u4")
    assert sum(r["c"] for r in row) == zlib.crc32(ids.tobytes()) or len(row) > 1
