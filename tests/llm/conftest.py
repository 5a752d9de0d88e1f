import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, ids string, line string"


@pytest.fixture(scope="session")
def documents(spark):
    import __spark_entry__ as entry

    return spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    long = " ".join(f"word{i % 97} is of the kind{i % 89}." for i in range(9000))
    rows = [
        (1, "A plain text. It has some words in it.\nAnd a line.", "en", "a"),
        (1, "A plain text. It has some words in it.\nAnd a line.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \n\t ", "en", ""),
        (5, long, "en", "a"),
        (6, long, None, "b"),
        (7, "x" * 50_000, "en", "b"),
        (None, "no identifier here at all", None, None),
        (None, None, None, None),
        (8, "Éàü 日本語 🙂 <|endoftext|> 'tis !!", "fr", "c"),
    ]
    full = [(i, t, g, s, None if t is None else len(t), "r", "i", "l") for i, t, g, s in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
