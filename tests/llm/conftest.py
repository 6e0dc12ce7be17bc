import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, lang]) rows, with an extra column of a clashing name."""
    schema = T._parse_datatype_string(
        "doc_id long, text string, lang string, source string, n_chars long, score string, `#text` string")

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", "y") for r in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank and very long texts, ties, repeated rows."""
    return [(1, "Hello world, this is a line"), (1, "Hello world, this is a line"), (2, None), (3, ""),
            (4, " \n\t "), (None, "no id here"), (None, None), (5, "word " * 60_000), (6, "x" * 300_000),
            (7, "123 456 !!"), (8, "日本語のテキスト"), (9, "a\nb\nc\na\nb\nc")]
