"""One document of each group of near copies, all links confirmed on the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import minhash, near_dedup
from starloom.llm.common import among
from starloom.llm.components import apart
from starloom.session import stage

#: Words of the shingles that similarity is measured on.
SIMILAR_WORDS = 5


def keep_one_of_each(
    docs: DataFrame,
    radius: int = near_dedup.RADIUS,
    words: int = near_dedup.SHINGLE_WORDS,
    similar_words: int = SIMILAR_WORDS,
    percent: int = minhash.PERCENT,
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest ``doc_id`` stays.

    Candidates are rows with SimHash fingerprints within ``radius`` bits, found as by
    :func:`starloom.llm.near_dedup.near_components`, and, as copies of a similarity of 0.8 often differ in more
    bits, rows that share a bucket of :mod:`starloom.llm.minhash`. A candidate is a link only if the sets of shingles of
    ``similar_words`` words, compared word by word, have ``percent`` per cent of their union in common. Null ids
    come last, and of rows with equal ids one stays. Rows without words are alike: one of them stays. All columns are
    kept, whatever their names; empty table: no rows.
    """
    number = next(n for i in range(len(docs.columns) + 1) if (n := f"row_{i}") not in docs.columns)
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "dedup-rows")
    texts = rows.select(F.col(number).alias("row"), "doc_id", "text")
    no_words = F.lit(bytearray())
    signed = stage(minhash.marked(texts, similar_words).withColumn("digest", F.coalesce("digest", no_words)), "dedup-signed")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    sets = stage(signed.groupBy("digest").agg(F.min("row").alias("node"), F.min(row).alias("first")), "dedup-sets")
    nodes = among(signed.where("n > 0"), sets.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "n", "buckets")
    nodes = stage(nodes, "dedup-nodes")

    first_texts = among(texts.select(F.col("row").alias("node"), "text"), nodes, "node")
    prints = stage(first_texts.select("node", near_dedup.shingle_fingerprint(F.col("text"), words).alias("fp")), "simhash-nodes")
    hubs = stage(prints.groupBy("fp").agg(F.min("node").alias("hub")), "simhash-hubs")
    same = prints.join(hubs, "fp").where("node <> hub").select("hub", "node")
    near = near_dedup.links(hubs, "fp", radius).distinct()
    near = near.join(hubs.toDF("a", "x"), "a").join(hubs.toDF("b", "y"), "b").select(F.least("x", "y").alias("hub"), F.greatest("x", "y").alias("node"))

    roots = minhash.node_roots(nodes, texts.select("row", "text"), similar_words, percent, same.unionByName(near))
    joined = stage(sets.join(apart(roots), "node", "left").select("first", F.coalesce("root", "node").alias("root")), "dedup-roots")
    kept = stage(joined.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(number)), "dedup-kept")
    return among(rows, kept, number).drop(number)
