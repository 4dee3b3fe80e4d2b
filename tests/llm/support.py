"""Tables and helpers shared by the tests of this folder."""

import random
from pathlib import Path

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF_DIR = Path("/root/testdata/sf0.001")
DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])
# Names that an operator may use itself.
CLASHES = ["ids", "block", "key", "w", "f", "rank", "host", "n_words", "kept", "level", "component_id", "size", "token", "n",
           "_key", "_row", "_cut", "_words", "_of", "_copy", "row", "cut", "of", "second", "_doc", "_source", "_kept", "words", "doc"]


def documents(spark, rows):
    """A table of documents from (doc_id, text, lang, source), with more columns under names that operators use."""
    schema = StructType([*DOCUMENTS.fields, *[StructField(name, StringType()) for name in CLASHES]])
    return spark.createDataFrame([(*row, len(row[1] or ""), *["x"] * len(CLASHES)) for row in rows], schema)


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    known = [w for w in ("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(vocabulary))]
    return " ".join(draw.choice(known) for _ in range(words))


ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "  \t\n ", "en", "a"),
    (4, "One", "en", "a"),
    (4, "One", "en", "a"),
    (None, "no id at all here", "en", None),
    (5, "naïve café — ünïcödé 日本語 text 😀 \x0b end", "fr", "b"),
    (6, "word " * 30_000, "en", "b"),
    (7, "x" * 120_000, "de", "b"),
]


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("the given tables are not here")
    return str(SF_DIR)


@pytest.fixture(scope="session")
def given_documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
