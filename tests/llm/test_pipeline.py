from __future__ import annotations

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm import mixing, quality
from starloom.llm.common import table
from starloom.llm.queries import QUERIES
from tests.llm.test_corpus_dedup import kept_by_brute_force


def test_registered():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13


def test_stages_against_brute_force(spark, sf_dir):
    """Each stage on what the one before it kept, done again row by row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = corpus_pipeline.keep_good(spark, docs, sf_dir).cache()
    score = {r["doc_id"]: r["score"] for r in quality.scored(docs, table(spark, sf_dir, "labels", "doc_id", "quality")).collect()}
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {i for i, s in score.items() if s >= quality.THRESHOLD}

    single = corpus_pipeline.drop_near_copies(spark, good, sf_dir).cache()
    assert single.columns == docs.columns
    assert sorted(r["doc_id"] for r in single.collect()) == kept_by_brute_force({r["doc_id"]: r["text"] for r in good.collect()})

    mixed = corpus_pipeline.mix_sources(spark, single, sf_dir).cache()
    assert mixed.columns == docs.columns
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.taken_words(single).collect() if r["size"]}
    seen = Counter(r["doc_id"] for r in mixed.collect())
    assert all(seen[i] == n for i, n in times.items())

    pieces = corpus_pipeline.encode_pieces(spark, mixed, sf_dir)
    assert Counter(r["doc_id"] for r in pieces.collect()) == seen and pieces.where("NOT round_trip").count() == 0
    whole = QUERIES["pipeline"](spark, sf_dir)
    assert Counter(r["doc_id"] for r in whole.select("doc_id").collect()) == seen


def test_messy(spark, messy, no_docs, tmp_path):
    messy.select("doc_id").limit(0).selectExpr("doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    for start, rows in ((messy, True), (no_docs, False)):
        docs = start
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, str(tmp_path))
            assert docs.columns == start.columns
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0) is rows
