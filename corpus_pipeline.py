"""Training-corpus pipeline: quality, near-dedup, mixing, pieces.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import corpus_dedup, mixing, pieces, quality
from starloom.llm.common import table
from starloom.session import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: SimHash grids and MinHash buckets, links confirmed at a similarity of 0.8."""
    return corpus_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with the best segmentations."""
    return pieces.segmented(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Trained scores, XXH64 and lattice search are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
