"""Personal data: fixed patterns, and contexts bootstrapped from what they find.

Entities that the fixed patterns find are the seeds. The words around an entity are a lexical
pattern; the same pattern around other identifier-like strings proposes new instances. Spark holds
the bipartite graph of patterns and instances and scores both sides in turn: a pattern by its
instances believed in against those of other kinds and those known to be wrong, an instance by the
patterns that hold it. Strings that confident
patterns extract become further spans of the seeds' kind.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from despensa.llm.base import arrow_schema, slices, staged

# The kinds of the contract, in its order, and its patterns. A start inside a run that failed would
# fail too, so runs of digits are entered at their first digit only.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# An identifier-like string: a run without white space that holds a digit or an at sign.
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
# Identifiers of several words: groups of digits, and addresses that are spelled out.
SPACED = re.compile(r"(?<![\w+(])[+(]{0,2}[0-9][0-9().-]{0,20}(?: [0-9().-]{1,20}){1,9}(?!\w)"
                    r"|(?<!\S)[\w.+-]{1,40} at [\w-]{1,40}(?: dot [\w-]{1,40}){1,4}(?!\w)")
EDGE = "\"'`.,;:!?()[]{}<>|*#$%&"
# Context: so many words on the left and on the right; words of at most so many characters.
LEFT, RIGHT, WORD = 2, 1, 40
# How much an unseen string counts against a pattern, and what is added to smooth few seeds; a string
# is known to be wrong if under half of the strings of its shape, of so many at least, share a
# pattern with any seed.
DOUBT, SMOOTH, KNOWN = 0.1, 0.4, 20
# Strings of more characters are told apart by a hash, written in letters, behind their shape.
WRITTEN = 4 * WORD
RUNS = re.compile(r"[^\W\d_]+|[0-9]+")
IN_LETTERS = str.maketrans("0123456789", "ghijklmnop")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str):
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            pos = m.end()
        else:
            pos = at + 1
        at = text.find("@", pos)


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start; ends exclusive, code points."""
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 13 <= len(m[0]) <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((3, *m.span()))
    return found


def words_before(text: str, at: int) -> str:
    """The words left of a place, lower-cased, digits as 0; '^' where a line begins."""
    a = max(0, at - LEFT * (WORD + 1) - 2)
    line = text[a:at].rsplit("\n", 1)
    words = line[-1].split()
    out = words[-LEFT:]
    if len(words) < LEFT and (len(line) > 1 or a == 0):
        out = ["^", *out]
    return " ".join(out)


def words_after(text: str, at: int) -> str:
    line = text[at:at + RIGHT * (WORD + 1) + 2].split("\n", 1)
    words = line[0].split()
    return " ".join(words[:RIGHT]) if words else "$"


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: its left words, and its left and right word together."""
    left, right = words_before(text, start).casefold(), words_after(text, end).casefold()
    left, right = re.sub("[0-9]+", "0", left), re.sub("[0-9]+", "0", right)
    return [f"{left} _", f"{left.rsplit(' ', 1)[-1]} _ {right}"]


def mentions(text: str) -> tuple[list, list]:
    """The fixed spans, and (kind or -1, start, end, patterns) of all entities and candidates."""
    base = fixed_spans(text)
    out = [(k, a, b, patterns(text, a, b)) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    whole, i = [], 0
    for m in SPACED.finditer(text):
        a, b = m.span()
        while b > a and text[b - 1] in ".-(":
            b -= 1
        if text[a:b].count(")") < text[a:b].count("("):
            a += text[a:b].index("(") == 0
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        digits = sum(c in "0123456789" for c in text[a:b])
        if not any(x < b and y > a for x, y in taken[i:i + 4]) and (" at " in m[0] or 7 <= digits <= 19):
            whole.append((a, b))
            out.append((-1, a, b, patterns(text, a, b)))
    taken, i = sorted(taken + whole), 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if any(x < b and y > a for x, y in taken[i:i + 4]) or b - a < 3:
            continue
        out.append((-1, a, b, patterns(text, a, b)))
    return base, out


def written(said: str) -> str:
    """The string that stands for a mention; one of a long mention is short, has its shape and differs from others."""
    if len(said) <= WRITTEN:
        return said
    digest = hashlib.sha256(said.encode()).hexdigest().translate(IN_LETTERS)
    return f"{RUNS.sub(lambda m: '0' if m[0][0] in '0123456789' else 'a', said)[:WRITTEN]}#{digest}"


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One staged row per document: row, id, base spans, mentions."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"),
                       F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([rows.schema["id"], rows.schema["row"], *T._parse_datatype_string(
        "base array<struct<kind:int,start:long,stop:long>>, "
        "mentions array<struct<kind:int,start:long,stop:long,said:string,patterns:array<string>>>")])
    kinds = arrow_schema(T.StructType(schema.fields[2:]))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                base, said = [], []
                for t in part.column(1).to_pylist():
                    b, m = mentions(t or "")
                    base.append([{"kind": k, "start": x, "stop": y} for k, x, y in b])
                    said.append([{"kind": k, "start": x, "stop": y, "said": written(t[x:y]), "patterns": p}
                                 for k, x, y, p in m])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(base, kinds.field("base").type),
                     pa.array(said, kinds.field("mentions").type)], names=schema.names)

    return staged(rows.mapInArrow(run, schema), "mentions")


def bootstrap(scanned: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8
              ) -> DataFrame:
    """Patterns believed in: pattern, kind. Iterates over the graph of patterns and instances.

    Seeds have belief 1 in their kind. Each round a pattern's confidence in a kind is the sum of
    its distinct instances' beliefs in it, over all beliefs in its instances and the number of those
    known to be wrong, smoothed; unseen instances are unknown and count little. It needs ``support``
    instances believed in by at least half. An instance that is no seed then takes the best
    confidence, from ``confidence`` on, among its patterns. Sums are combined before each shuffle
    and the tables of a round are written, so a pattern that a third of all mentions share is split.
    """
    said = scanned.select(F.explode("mentions").alias("m")).select(
        F.xxhash64("m.said").alias("instance"), "m.kind", F.explode("m.patterns").alias("pattern"),
        F.xxhash64(F.regexp_replace(F.regexp_replace("m.said", r"\p{L}+", "a"), "[0-9]+", "0")).alias("shape"))
    edges = staged(said.groupBy(F.xxhash64("pattern").alias("pattern"), "instance").agg(
        F.max("kind").alias("kind"), F.max("shape").alias("shape")), "edges")
    # A pattern around one string alone says nothing about others, one without any seed nothing at first.
    every = staged(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(
        F.col("kind") >= 0, 1).otherwise(0)).alias("seeds")), "every")
    near = edges.filter("kind < 0").join(every.filter("seeds > 0").select("pattern"), "pattern").select(
        "instance", "shape").distinct().groupBy("shape").agg(F.count(F.lit(1)).alias("near"))
    wrong = edges.filter("kind < 0").select("instance", "shape").distinct().groupBy("shape").agg(
        F.count(F.lit(1)).alias("all")).filter(F.col("all") >= KNOWN).join(near, "shape", "left").filter(F.coalesce("near", F.lit(0)) * 2 < F.col("all"))
    wrong = staged(wrong.select("shape", F.lit(1).alias("wrong")), "wrong")
    edges = staged(edges.join(every.filter(F.col("n") >= support).select("pattern"), "pattern")
                   .join(wrong, "shape", "left").select(
                       "pattern", "instance", "kind", F.coalesce("wrong", F.lit(0)).alias("wrong")), "wide-edges")
    wide = staged(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(
        F.col("kind") < 0, F.col("wrong")).otherwise(0)).alias("bad")), "wide").withColumnRenamed("pattern", "w")
    seeds = staged(edges.filter("kind >= 0").select("instance", "kind").distinct()
                   .withColumn("belief", F.lit(1.0)), "seeds")
    belief, trusted = seeds, None
    for _ in range(rounds):
        held = edges.select("pattern", "instance").join(belief, "instance").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("sum"),
            F.sum(F.when(F.col("belief") >= 0.5, 1).otherwise(0)).alias("support"))
        # At most one row a kind and pattern.
        told = held.groupBy("pattern").agg(
            F.collect_list(F.struct("kind", "sum", "support")).alias("kinds"), F.sum("sum").alias("all"))
        open_ = F.greatest(F.col("n") - F.col("bad") - F.col("all"), F.lit(0.0))
        trusted = staged(
            told.join(wide, F.col("pattern") == F.col("w")).select(
                F.col("pattern").alias("p"), F.explode("kinds").alias("x"),
                (F.col("all") + F.col("bad") + DOUBT * open_ + SMOOTH).alias("against"))
            .select("p", F.col("x.kind").alias("kind"), F.col("x.support").alias("support"),
                    (F.col("x.sum") / F.col("against")).alias("confidence"))
            .filter((F.col("support") >= support) & (F.col("confidence") >= confidence))
            .select("p", "kind", "confidence"), "trusted")
        new = (edges.filter("kind < 0 AND wrong = 0").select("pattern", "instance")
               .join(trusted, F.col("pattern") == F.col("p"))
               .groupBy("instance", "kind").agg(F.max("confidence").alias("belief")))
        belief = staged(seeds.unionByName(new), "belief")
    return trusted.groupBy("p").agg(F.max(F.struct("confidence", F.col("kind"))).alias("x")).select(
        "p", F.col("x.kind").alias("k"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
         support: int = 3, confidence: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: its id, base, learned (arrays of kind, start, stop by kind and
    start; code points, stop exclusive).

    ``base`` are the fixed patterns' spans, ``learned`` what bootstrapped patterns add; they never
    overlap base spans. Null and empty texts have none, null ids are kept, repeated rows come back
    as often, an empty table gives no rows. Other columns are not read.
    """
    scanned = scan(docs, id_col, text_col)
    trusted = staged(bootstrap(scanned, rounds, support, confidence), "patterns")
    open_ = scanned.select("row", F.explode("mentions").alias("m")).filter("m.kind < 0").select(
        "row", "m.start", "m.stop", F.explode("m.patterns").alias("pattern"))
    learned = staged(
        open_.select("row", "start", "stop", F.xxhash64("pattern").alias("pattern"))
        .join(trusted, F.col("pattern") == F.col("p"))
        .groupBy("row", "start", "stop").agg(F.min("k").alias("kind"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("learned")),
        "learned").withColumnRenamed("row", "r")
    none = F.array().cast("array<struct<kind:int,start:long,stop:long>>")
    return scanned.join(learned, F.col("row") == F.col("r"), "left").select(
        F.col("id").alias(id_col), "base", F.coalesce("learned", none).alias("learned"))


def spans_text(spans) -> Column:
    """kind:start:stop, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.stop.cast("string"))), ",")
