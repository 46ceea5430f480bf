"""The registered queries of the operators: thin views over whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    alignment,
    fingerprints,
    html_text,
    licenses,
    minhash,
    mixing,
    near_dedup,
    neighbours,
    pieces,
    quality,
    runs,
    token_counts,
    url_filter,
)
from starloom.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scored(table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels", "doc_id", "quality"))


def op2_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.segmented(table(spark, sf, "documents", "doc_id", "text"))


def op3_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_components(table(spark, sf, "documents", "doc_id", "text"))


def op4_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf, "documents", "doc_id", "text"))


def op5_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(table(spark, sf, "embeddings", "vec_id", "embedding"))


def op6_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents", "doc_id", "text"))


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.counted(table(spark, sf, "documents", "doc_id", "text"))


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages", "page_id", "url", "html"))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf, "documents", "doc_id", "source", "text"))


def op10_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extracted(table(spark, sf, "pages", "page_id", "url", "html"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found = alignment.aligned(table(spark, sf, "documents", "doc_id", "text"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.with_counts(found, "doc_id", "n_a", "n_b", "n_groups", digest)


def op12_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = runs.find_runs(docs.select("doc_id", runs.with_planted_period(F.col("doc_id"), F.col("text")).alias("text")))
    best = runs.strongest(F.col("runs")).alias("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    digests = F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best, *digests)
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")


def op13_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_components(table(spark, sf, "documents", "doc_id", "text"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op3_near_dedup": op3_near_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_neighbours": op5_neighbours,
    "op6_licenses": op6_licenses,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_html_text": op10_html_text,
    "op11_alignment": op11_alignment,
    "op12_runs": op12_runs,
    "op13_minhash": op13_minhash,
    "pipeline": corpus_pipeline.run,
}
