from __future__ import annotations

import pytest

LONG = "abc defg hij " * 40_000

#: Nulls in every column, empty and very long texts, ties, repeated rows.
MESSY = [
    (0, "the cat sat on the mat and looked at the dog", "en", "a", 1, "x"),
    (0, "the cat sat on the mat and looked at the dog", "en", "a", 1, "x"),
    (50, "the cat sat on the mat and looked at the dog", None, "b", None, None),
    (100, "", "en", None, 0, "x"),
    (150, None, None, None, None, None),
    (None, "words without any id at all but with text", "en", "b", 5, "y"),
    (None, None, None, None, None, None),
    (200, LONG, "fr", "c", len(LONG), "x"),
    (250, "  \n\t ", "en", "c", 5, "x"),
    (300, "Ünïcode ▁ text — with “marks” and 日本語 .", "xx", "Ä", 1, "x"),
    (350, "Released under the MIT License.\nother text", "en", "a", 3, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string"


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with an extra column whose name clashes with a result column."""
    return spark.createDataFrame(MESSY, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def folder(path, **tables):
    """Write tables as the query folder ``path``."""
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
