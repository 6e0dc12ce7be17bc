import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from despensa.llm import fingerprints as fp


def plain_hash(data, i):
    """The rolling hash at byte i, term by term."""
    h = sum((data[i - j] + 1) * fp.WEIGHTS[j] for j in range(fp.WINDOW) if i - j >= 0) % 2**32
    h = (h ^ (h >> 15)) * 0x85EBCA6B % 2**32
    return h ^ (h >> 13)


def plain_fingerprint(text):
    data = text.encode()
    hashes = [plain_hash(data, i) for i in range(len(data))]

    def ends(level):
        return [i + 1 for i, h in enumerate(hashes) if h % 2**level == 0] if level <= 32 else []

    level = next(k for k in range(40) if len(ends(k)) <= fp.ENDS)

    def letters(level):
        cut = [0, *ends(level), len(data)]
        import zlib
        return "".join(fp.LETTERS[zlib.crc32(data[a:b]) & 63] for a, b in zip(cut, cut[1:]) if b > a)

    return f"{2**level}:{letters(level)}:{letters(level + 1)}"


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def brute(rows):
    """Edited fingerprints by definition, over (doc_id, text)."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (
        r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).digest()[:16]))
    out = []
    for (d, t), (_, after) in zip(order, [*order[1:], *order[:1]]):
        n = len(t) // 3
        changed = t[:len(t) - n] + after[:n]
        a, b = plain_fingerprint(t), plain_fingerprint(changed)
        out.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, fp.likeness(a, b),
                    fp.likeness(a, plain_fingerprint(after))))
    return sorted(out, key=repr)


def edited(docs):
    return sorted((tuple(r) for r in fp.edited_fingerprints(docs).select(*fp.NAMES).collect()), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300) | st.text(alphabet="ab ", max_size=2000) | st.text(alphabet="é日😀", max_size=100))
def test_fingerprint_by_definition(text):
    assert fp.fingerprint(text) == plain_fingerprint(text)


def test_long_texts_in_blocks_are_hashed_whole(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "épsilon"]) for _ in range(2000))
    whole = fp.fingerprint(text)
    monkeypatch.setattr(fp, "BLOCK", 100)
    assert fp.fingerprint(text) == whole == plain_fingerprint(text)
    assert fp.fingerprint(text[:-1] + "X") != whole
    assert len(fp.fingerprint("x" * 5000).split(":")[1]) <= fp.ENDS + 1


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcd", max_size=70), st.text(alphabet="abcd", max_size=70))
def test_edit_distance_by_definition(a, b):
    assert fp.common(a, b) == plain_common(a, b)
    assert 0 <= fp.alike(a, b) <= 1 and fp.alike(a, b) == fp.alike(b, a)


def test_edits_stay_near_and_others_far():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([20, 100, 1000]))) for _ in range(60)]
    marks = [fp.fingerprint(t) for t in texts]
    for t, m, other in zip(texts, marks, [*texts[1:], texts[0]]):
        assert fp.likeness(m, fp.fingerprint(fp.edit(t, other))) >= 0.45
        assert fp.likeness(m, fp.fingerprint(t[: len(t) // 2] + "zz" + t[len(t) // 2:])) >= 0.75
    far = [fp.likeness(a, b) for i, a in enumerate(marks) for b in marks[:i]]
    assert sum(x > 0 for x in far) / len(far) < 0.02


def test_edited_as_brute_force(docs_of):
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choice(["un", "deux", "trois", "quatre", "日本"]) for _ in range(rng.randint(0, 60))))
            for i in range(200)]
    assert edited(docs_of(rows)) == brute(rows)


def test_odd_rows(docs_of, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 10_000] + [(2**62, "big"), (-5, "below")]
    assert edited(docs_of(rows)) == brute(rows)
    assert edited(docs_of([])) == []
    assert edited(docs_of([(7, "alone it follows itself")])) == brute([(7, "alone it follows itself")])
    assert fp.edited_fingerprints(docs_of(odd_rows)).count() == len(odd_rows)


def test_a_third_of_the_rows_share_an_id(docs_of):
    rows = [(5, f"text number {i} " * (i % 4)) for i in range(150)] + [(i, f"other {i}") for i in range(300)]
    rows += [(None, f"nameless {i}") for i in range(100)]
    assert edited(docs_of(rows)) == brute(rows)


def test_fingerprints_and_compared(docs_of):
    marked = fp.fingerprints(docs_of([(1, "a b c d e f"), (2, None), (3, "")]))
    got = {r["doc_id"]: r["fingerprint"] for r in marked.collect()}
    assert got[2] == got[3] == "1::" and got[1] == plain_fingerprint("a b c d e f")
    pairs = marked.sparkSession.createDataFrame(
        [(got[1], got[1]), (got[1], got[2]), (None, got[1])], "x string, y string")
    assert [r["likeness"] for r in fp.compared(pairs, "x", "y").collect()] == [1.0, 0.0, None]


@pytest.mark.parametrize("a, b, want", [("2:abcdefgh:ij", "2:abcdefgh:kl", 1.0), ("4:abcdefgh:x", "2:zz:abcdefgh", 1.0),
                                        ("8:abcdefgh:x", "2:abcdefgh:abcdefgh", 0.0), ("1::", "1:a:a", 0.0)])
def test_compatible_block_sizes(a, b, want):
    assert fp.likeness(a, b) == fp.likeness(b, a) == want
