"""Rows wanted by their number, without a shuffle of the others."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from starloom.llm import corpus_dedup, minhash
from starloom.llm.common import among

NUMBERS = [-(2**63), -65, -64, -1, 0, 1, 62, 63, 64, 65, 127, 128, 5 << 33, (5 << 33) + 63, 2**63 - 1]


@pytest.fixture
def no_broadcasts(spark):
    """As on tables that are too large for a broadcast of Spark's own choice."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_rows_wanted_and_no_others(spark, most):
    """Signs, ends of masks, repeats on both sides and nulls; also where keys are too many to be broadcast."""
    choose = random.Random(5)
    rows = [*NUMBERS, *NUMBERS, *(choose.randrange(-500, 500) for _ in range(300)), None]
    keys = [*NUMBERS[::2], *NUMBERS[::4], *(choose.randrange(-500, 500) for _ in range(200)), None]
    found = among(spark.createDataFrame([(r, str(r)) for r in rows], "row_0 long, text string"), spark.createDataFrame([(k,) for k in keys], "row_0 long"), "row_0", most)
    assert found.columns == ["row_0", "text"]
    wanted = set(keys) - {None}
    assert Counter(r[0] for r in found.collect()) == Counter(r for r in rows if r in wanted)
    assert among(found, spark.createDataFrame([], "row_0 long"), "row_0", most).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_details_shuffle_no_texts(no_broadcasts):
    texts = no_broadcasts.createDataFrame([(i, f"a b c {i}") for i in range(50)], "row long, text string")
    details = minhash._details(no_broadcasts.createDataFrame([(3,), (7,), (7,)], "node long"), texts, 2)
    assert "hashpartitioning" not in _plan(details).replace("hashpartitioning(__block", "")
    assert sorted(r["node"] for r in details.collect()) == [3, 7]


def test_only_wanted_texts_are_confirmed(no_broadcasts, monkeypatch):
    """Of 400 texts the three that the pairs name are left before a shuffle."""
    counts = []
    real = among

    def counted(rows, keys, column):
        counts.append((found := real(rows, keys, column)).count())
        return found

    monkeypatch.setattr(minhash, "among", counted)
    texts = no_broadcasts.createDataFrame([(i, "a b c d e f g h i j" if i < 3 else f"x {i}") for i in range(400)], "row long, text string")
    links = minhash.confirmed(no_broadcasts.createDataFrame([(0, 1), (0, 2)], "hub long, node long"), texts)
    assert sorted(map(tuple, links.collect())) == [(0, 1), (0, 2)]
    assert counts == [3]


def test_kept_documents_are_not_shuffled(no_broadcasts):
    docs = no_broadcasts.createDataFrame([(i, f"word{i} " * 9) for i in (1, 1, 2, 3, 4)], "doc_id long, text string")
    kept = corpus_dedup.keep_one_of_each(docs)
    assert "SortMergeJoin" not in _plan(kept) and "hashpartitioning" not in _plan(kept)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]
