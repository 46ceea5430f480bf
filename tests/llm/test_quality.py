from __future__ import annotations

import zlib

import numpy as np
import pytest
from starloom.llm import quality
from starloom.llm.common import table
from starloom.llm.queries import QUERIES


def test_terms():
    counts = quality.terms_of(b"AB ab ab, 12")
    assert counts.sum() == 11 + 0 + 0  # eleven neighbouring pairs, no word twice in a row, none in the window
    repeated = quality.terms_of(b"go go go stop")
    assert repeated[-2] == 2 and repeated[-1] == 2
    assert not quality.terms_of(b"").any()


def test_scores_match_plain_votes():
    random = np.random.default_rng(3)
    counts = random.integers(0, 5, (60, quality.TERMS)).astype(np.float32)
    labels = random.integers(0, 2, 60)
    model = quality.Model.fit(counts, labels, 0.7, 8)
    got = model.scores(counts[:20], 5)
    for row, score in zip(counts[:20], got):
        v = np.sqrt(row / row.sum()) * model.weights @ model.projection
        v /= np.linalg.norm(v)
        near = [(round(float(v @ w), 6), -i, y) for i, (w, y) in enumerate(zip(model.vectors, labels))]
        best = sorted(near, reverse=True)[:5]
        force = [max(s, 0) ** quality.SHARPNESS for s, _, _ in best]
        assert score == pytest.approx(sum(f * y for f, (_, _, y) in zip(force, best)) / sum(force), abs=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality_classifier"](spark, sf)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == table(spark, sf, "documents", "doc_id").count()
    got = rows.join(table(spark, sf, "labels", "doc_id", "quality"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.97


def test_learns_only_from_rows_that_are_not_held_out(spark):
    docs = spark.createDataFrame([(i, "THIS IS!! LOUD!!" if i % 2 else "this is calm") for i in range(60)], "doc_id long, text string")
    true = [(i, i % 2 ^ 1) for i in range(60)]
    wrong = [(i, y ^ 1 if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in true]
    a, b = (
        {r["doc_id"]: r["score"] for r in quality.scored(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()}
        for x in (true, wrong)
    )
    assert a == b and all(a[i] == y for i, y in true)


def test_messy(spark, messy, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, 1), (200, 0), (50, None), (None, 1), (999, 1)], "doc_id long, quality int")
    rows = quality.scored(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.scored(no_docs, labels).count() == 0
    none = quality.scored(messy, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.accepted(messy, labels).columns == messy.columns
