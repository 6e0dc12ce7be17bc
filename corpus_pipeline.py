"""The corpus pipeline: documents to packed sequences of token ids, in five stages.

Each stage reads what the one before wrote and calls one operator. All but the last return the
columns of documents.

Null, empty and repeated texts: texts without letters go in the first stage; a text emptied by line
dedup stays as an empty document until SimHash keeps one of each group of near copies; documents
with a null id stay there, as nothing names them. Documents that hold a window of a benchmark item
go. Extra columns go along up to the last stage, which returns pieces. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa.llm import decontaminate, langid, linededup, packing, simhash
from despensa.llm.base import staged, unused


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the centroids accept."""
    return langid.keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated three-line windows out of the texts; n_chars follows the text."""
    counted = unused(docs.columns, "lines_removed")
    clean = linededup.dedup_lines(docs, counted=counted)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(
            F.col(f"`{counted}`") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or a whole shorter one.

    Whether one does follows from its text, so texts are told apart by their hash, whatever ids
    they have.
    """
    name = unused(docs.columns, "#text")
    named = docs.withColumn(name, F.sha2("text", 256))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(named, items, id_col=name)
    other = unused(named.columns, "#leaked")
    leaked = found.filter("contaminated").select(F.col(f"`{name}`").alias(other)).distinct()
    # Always a merge join: what moves must not depend on whether the list fits a broadcast.
    return named.join(staged(leaked, "leaked").hint("merge"), F.col(f"`{name}`") == F.col(other), "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 2048."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("harmonic_packing", harmonic_packing)]

# The language model, fingerprints and token ids have no SQL form; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
