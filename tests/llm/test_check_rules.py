"""Rules that hold for all operators: no case is dropped by row caps, and nothing is kept on one machine."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
import starloom.llm
from pyspark.sql import functions as F
from starloom.llm import common, token_counts
from starloom.llm.queries import QUERIES

SOURCES = sorted(Path(starloom.llm.__file__).parent.glob("*.py"))


@pytest.mark.parametrize("path", SOURCES, ids=lambda p: p.stem)
def test_no_local_checkpoints_folders_or_rdds(path):
    code = path.read_text()
    assert not re.search(r"localCheckpoint|tempfile|crossJoin|\.rdd\b|toPandas", code)


def test_nothing_else_imports_the_subpackage():
    root = Path(starloom.llm.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "starloom.llm" not in path.read_text()


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op2_sentence_pieces", "op3_near_dedup", "op7_token_counts", "op9_mixing"])
def test_one_row_per_document(spark, sf_dir, name):
    docs = common.table(spark, sf_dir, "documents", "doc_id")
    assert QUERIES[name](spark, sf_dir).select("doc_id").exceptAll(docs).count() == 0
    assert docs.exceptAll(QUERIES[name](spark, sf_dir).select("doc_id")).count() == 0


def test_slices_keep_order_and_length(spark):
    rows = spark.range(2000).select("id", F.lit("a b c").alias("text")).coalesce(1)
    got = token_counts.counted(rows.withColumnRenamed("id", "doc_id")).collect()
    assert [r["doc_id"] for r in got] == list(range(2000)) and {r["n_words"] for r in got} == {3}


def test_hexadecimal_and_signed(spark):
    values = [0, 1, (1 << 63), (1 << 64) - 1]
    rows = spark.createDataFrame([(common.signed(v),) for v in values], "v long").select(common.hex64(F.col("v")).alias("h")).collect()
    assert [r["h"] for r in rows] == [f"{v:016x}" for v in values]
