"""The pipeline's stages on a small fixture, each against brute force on the same input."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_fingerprint, brute_lines
from test_packing import check_packed
from test_search import brute_hits
from tokenizers import Tokenizer

import corpus_pipeline
from despensa.llm import langid
from despensa.llm.base import tokenizer_path


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """Documents of the test tables with planted copies and passages."""
    out = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    passage = bench.orderBy("item_id").first()["text"]
    base = next(r for r in rows if r[2] == "en" and 1500 < len(r[1]) < 4000)
    n = 10_000
    shared = "\n".join(base[1].split(". ")[:6])
    rows += [(n, base[1], *base[2:]), (n + 1, base[1].replace(" the ", " thee ", 1), *base[2:]),
             (n + 2, base[1][:800] + "\n" + passage, *base[2:]), (n + 3, None, "en", "s", None),
             (n + 4, "", None, "s", 0), (n + 5, "12 34", "en", "s", 5), (n + 6, shared + "\nown words here", *base[2:]),
             (n + 7, shared + "\nother words there", *base[2:]), (n + 7, shared + "\nother words there", *base[2:])]
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{out}/documents.parquet")
    bench.write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages_as_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, [tuple(r) for r in docs.collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "benchmark_decontamination", "harmonic_packing"]
    model = langid.fit(docs)
    rejected = {(r["doc_id"], r["text"]) for r in langid.predict(docs, model).filter("rejected").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == columns and got.schema == docs.schema
        if name == "language_id":
            want = [r for r in rows if (r[0], r[1]) not in rejected]
            assert len(want) >= 0.97 * (len(rows) - 3)
        elif name == "line_dedup":
            told = brute_lines([r[:2] for r in rows])
            want = [(r[0], told[r[:2]], *r[2:4], r[4] if told[r[:2]] == r[1] else len(told[r[:2]])) for r in rows]
        elif name == "near_dedup":
            comp = brute_components([brute_fingerprint(r[1]) for r in rows], 4)
            least = {}
            for r in rows:
                c = comp[brute_fingerprint(r[1])]
                least[c] = min(least.get(c, r[0]), r[0])
            want = [r for r in rows if least[comp[brute_fingerprint(r[1])]] == r[0]]
            assert len(want) < len(rows) - 1
        else:
            want = [r for r in rows if brute_hits(r[1], items)[1] == 0]
            assert 10_002 not in {r[0] for r in want}
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)), name
        rows = want
        docs = spark.createDataFrame(rows, docs.schema).repartition(3)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    check_packed(packed, [r[:2] for r in rows], Tokenizer.from_file(tokenizer_path()), 1, 2048)
    run = corpus_pipeline.run(spark, folder).collect()
    assert {(r["doc_id"], r["doc_tokens"]) for r in run} == {(r["doc_id"], r["doc_tokens"]) for r in packed}
    assert sum(r["length"] for r in run) == sum(r["length"] for r in packed)
    assert len(np.frombuffer(bytes(run[0]["ids"]), "<u4")) == run[0]["length"]


def test_empty_and_extra_columns(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(5).selectExpr(
        "*", "1 AS score", "2 AS lines_removed", "3 AS `#text`", "4 AS `#gone`", "5 AS rejected", "6 AS th")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0


def test_without_a_language_no_text_goes(spark, folder):
    """Nothing is known to reject by: every text with a letter stays."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, docs, folder)
    assert kept.columns == docs.columns
    want = [r for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert kept.count() == len(want) > 200
    told = langid.predict(docs, None, keep=["doc_id"]).collect()
    assert {(r["lang_pred"], r["score"]) for r in told} == {("und", 0.0)}


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from despensa.session import crear_sesion
spark = crear_sesion("local[4]", "apart", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
spark.sparkContext.setLogLevel("OFF")

def there(_):
    import importlib.util
    yield importlib.util.find_spec("despensa") is not None

assert spark.sparkContext.parallelize([0], 1).mapPartitions(there).collect() == [False], "workers see the package"
import __spark_entry__ as e
bad = []
for name, f in e.queries().items():
    if (name.startswith("op") and name[2].isdigit()) or name in ("pipeline", "ts_base_modelo", "ts_wf_multi", "st_pacf"):
        try:
            print(name, f(spark, {sf!r}).count(), flush=True)
        except Exception as x:
            bad.append((name, str(x)[-300:]))
assert not bad, bad
print("all ran")
"""


def test_workers_need_no_copy_of_the_package(sf, tmp_path):
    """Every operator and the pipeline, with worker processes that can't import the package."""
    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "apart.py"
    script.write_text(SCRIPT.format(repo=repo, sf=os.path.abspath(sf)))
    r = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, text=True, capture_output=True, timeout=900)
    assert r.returncode == 0 and "all ran" in r.stdout, r.stdout[-1500:] + r.stderr[-3000:]
