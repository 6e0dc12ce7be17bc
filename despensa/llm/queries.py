"""The registered queries, one per operator, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa.llm import (
    conversations,
    decontaminate,
    fingerprints,
    langid,
    linededup,
    packing,
    phrases,
    pii,
    simhash,
    tokenfiles,
    topk,
    toxicity,
    wrappers,
)
from despensa.llm.base import held_out

CONSULTAS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        CONSULTAS[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LINES = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
told AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS t FROM l),
numbered AS (
  SELECT doc_id, place, t, row_number() OVER w AS nr,
    lead(t, 1) OVER w AS t2, lead(t, 2) OVER w AS t3, lead(place, 2) OVER w AS until
  FROM told WHERE t <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY t, t2, t3 ORDER BY doc_id, nr) AS n
  FROM numbered WHERE until IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, until + 1)) AS place FROM seen WHERE n > 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY place) FILTER (g.place IS NULL) AS text,
    count(g.place) AS removed
  FROM l LEFT JOIN gone g USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST(coalesce(k.removed, 0) AS INTEGER) AS lines_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


@query("op2_line_windows", LINES)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "text", "lines_removed")


@query("op3_covering_simhash")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, radius=4)


@query("op5_harmonic_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset")


@query("op7_centroid_langid")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    model = langid.fit(docs.filter(~F.col("held_out")))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


HITS = """
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS w FROM (
    SELECT item_id, ws, least(len(ws), 10) AS n,
      unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM items WHERE len(ws) > 0)),
places AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS w FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p
    FROM low, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
hits AS (SELECT doc_id, item_id, p, n FROM places JOIN windows USING (n, w)),
words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits)
  GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items,
    string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op8_positional_index", HITS)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@query("op9_columnar_topk", TOP)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


@query("op6_ranked_id_files")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    written = tokenfiles.write_ids(table(spark, folder, "documents"))
    return tokenfiles.read_ids(spark, written).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op1_convolutional_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out("doc_id", 3, 1))
    model = toxicity.fit(docs.filter(~F.col("held_out")), table(spark, folder, "labels"))
    return toxicity.score(docs, model, keep=["doc_id", "held_out"])


@query("op4_bootstrapped_pii")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s.kind)
    # The kinds' places: what is left of an array without a value is shorter by its count.
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.array_sort(F.concat("base", "learned"))).alias("spans"))


@query("op10_page_wrappers")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract_text(table(spark, folder, "pages"))


PHRASES = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS ws FROM documents),
f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS n FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
    FROM pieces, (VALUES (1), (2), (3)) sizes(k) WHERE len(ws) >= k)
  GROUP BY ALL),
often AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE n >= 10),
cuts AS (
  SELECT lang, phrase, ws, n AS a, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (
  SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, n
  FROM often WHERE k = 3),
gone AS (
  SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_pairs i USING (lang, phrase) WHERE 100 * i.n >= 50 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best ANTI JOIN gone USING (lang, phrase)),
sizes AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


@query("op11_toivonen_phrases", PHRASES)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), longest=3, at_least=10, first=2000, inside=50)


TRIE = """
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''),
    substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, own, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, b)),
    CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h FROM c),
s AS (
  SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS seq
  FROM h LEFT JOIN h b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM s),
nodes AS (
  SELECT depth, seq[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(seq) = depth), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
told AS (
  SELECT n.*, coalesce(len(regexp_extract_all(node[depth].text, '[^\\x20\\x09-\\x0D]+')), 0) AS words,
    (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.node[1:n.depth] = n.node) AS n_children
  FROM nodes n),
below AS (
  SELECT t.depth, t.node, CAST(count(*) FILTER (u.n_children = 0) AS BIGINT) AS n_leaves,
    CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens
  FROM told t JOIN told u ON u.depth >= t.depth AND u.node[1:t.depth] = t.node GROUP BY 1, 2)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, b.n_leaves, b.saved_tokens, t.ends_sha256
FROM told t JOIN below b ON b.depth = t.depth AND b.node = t.node
LEFT JOIN nodes p ON p.depth = t.depth - 1 AND p.node = t.node[1:t.depth - 1]
"""


@query("op12_conversation_trie", TRIE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversations.rebuilt(conversations.turns_of(table(spark, folder, "conversations")), group=20, most=3)
    return conversations.prefix_trie(turns).drop("key", "parent")


@query("op13_piecewise_fingerprints")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))
