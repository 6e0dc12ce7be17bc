"""What the bootstrapping finds of identifiers that no fixed pattern knows, planted among decoys."""

import random

from despensa.llm import pii

# (context, kind): what stands around an identifier of the kind.
CONTEXTS = [("please write to {} today", 0), ("mail me at {} or come by", 0), ("contact address: {} (office)", 0),
            ("call me on {} after six", 3), ("my phone is {} these days", 3), ("reach the desk via {} any time", 3)]
DECOYS = ["order number {} was sent", "version {} is out", "see page {} of the report", "commit {} broke it",
          "room {} is on the left", "we sold {} pieces of it"]


def email(rng):
    return f"{rng.choice('abcdefgh')}{rng.randint(1, 9999)}.{rng.choice(['lee', 'kim', 'roy'])}@{rng.choice(['mail', 'post'])}{rng.randint(1, 99)}.org"


def unseen_email(rng):
    name, place = f"{rng.choice('abcdefgh')}{rng.randint(1, 9999)}", f"{rng.choice(['mail', 'post'])}{rng.randint(1, 99)}"
    return rng.choice([f"{name}(at){place}.org", f"{name}[at]{place}[dot]org", f"{name} at {place} dot org"])


def phone(rng):
    return "+49 " + " ".join(str(rng.randint(100, 999)) for _ in range(3))


def unseen_phone(rng):
    return rng.choice([f"0{rng.randint(100, 999)} {rng.randint(1000000, 9999999)}", f"0{rng.randint(100, 999)}/{rng.randint(100000, 999999)}",
                       f"0{rng.randint(100, 999)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"])


def decoy(rng):
    return rng.choice([str(rng.randint(1, 99999)), f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}",
                       f"{rng.getrandbits(48):012x}", f"B-{rng.randint(100, 999)}"])


def planted(docs=2500, seed=11):
    """Texts, and the spans of planted unseen identifiers by document."""
    rng = random.Random(seed)
    rows, want = [], {}
    for d in range(docs):
        parts, at, spans = [], 0, set()
        for _ in range(rng.randint(1, 4)):
            filler = " ".join(rng.choice(["the", "house", "stands", "near", "a", "river", "and", "old"]) for _ in range(rng.randint(3, 9)))
            if rng.random() < 0.5:
                context, kind = rng.choice(CONTEXTS)
                seen = rng.random() < 0.6
                said = (email if kind == 0 else phone)(rng) if seen else (unseen_email if kind == 0 else unseen_phone)(rng)
            else:
                context, kind, seen, said = rng.choice(DECOYS), None, True, decoy(rng)
            text = f"{filler}. {context.format(said)}. "
            if not seen:
                start = at + len(filler) + 2 + context.index("{")
                spans.add((kind, start, start + len(said)))
            parts.append(text)
            at += len(text)
        rows.append((d, "".join(parts)))
        want[d] = spans
    return rows, want


def test_planted_identifiers(docs_of):
    rows, want = planted()
    found = {r["doc_id"]: {(s["kind"], s["start"], s["stop"]) for s in r["learned"]} for r in pii.find(docs_of(rows)).collect()}
    right = sum(len(found[d] & want[d]) for d in want)
    recall, precision = right / sum(map(len, want.values())), right / sum(map(len, found.values()))
    print(f"planted {sum(map(len, want.values()))}, recall {recall:.3f}, precision {precision:.3f}")
    assert recall >= 0.9 and precision >= 0.9


def test_long_mentions_are_candidates_too(docs_of):
    """A key of 1,000 characters in the context of known identifiers is found whole, a blob elsewhere is not."""
    rng = random.Random(5)
    # No run of digits that is a card of its own.
    long = ["".join(rng.choice("abcdef") + str(rng.randint(0, 9)) for _ in range(500)) for _ in range(8)]
    rows = [(i, f"please write to {email(rng)} today") for i in range(60)]
    rows += [(100 + i, f"please write to {x}@ today") for i, x in enumerate(long)]
    rows += [(200 + i, f"the blob {x[::-1]} was stored") for i, x in enumerate(long)]
    found = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["learned"]] for r in pii.find(docs_of(rows)).collect()}
    assert all(found[100 + i] and found[100 + i][0][0] == 16 and found[100 + i][0][1] >= 1016 for i in range(8))
    assert not any(found[200 + i] for i in range(8))
    a, b = pii.written(long[0]), pii.written(long[1])
    assert a != b and len(a) < 300 and pii.written("short 1") == "short 1"
