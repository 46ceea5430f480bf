"""Quality classifier: similarity-weighted votes of labelled documents in a latent-semantic space.

Terms of a text are the pairs of neighbouring character classes (letters by case, digits,
white space, and every punctuation mark by itself) and repeated words, so they look alike in
all languages. Square roots of term shares, weighted by inverse document frequency, are projected
on the leading singular vectors of a bounded labelled sample. The sample's vectors are broadcast, and
each document meets all of them in blocks of exact cosine products.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starloom.llm.common import slices, utf8

#: Labelled rows of each class that the model is fitted on, at most; so the broadcast is below 2 MB.
SAMPLE_PER_CLASS = 2000
DIMENSIONS = 48
NEIGHBOURS = 15
#: Similarities are raised to this power before they weigh a neighbour's label.
SHARPNESS = 4
THRESHOLD = 0.3
#: Words among which a repetition counts.
WINDOW = 64

_OTHER = 6
_CLASSES = _OTHER + len(string.punctuation)
TERMS = _CLASSES * _CLASSES + 2


def _classes() -> np.ndarray:
    """Class of every byte: lower-case or non-ASCII, upper-case, digit, line end, blank, control, one per mark."""
    of = np.zeros(256, np.int64)
    for byte in range(128):
        char = chr(byte)
        if char in string.punctuation:
            of[byte] = _OTHER + string.punctuation.index(char)
        elif char.isupper():
            of[byte] = 1
        elif char.isdigit():
            of[byte] = 2
        elif char == "\n":
            of[byte] = 3
        elif char.isspace():
            of[byte] = 4
        elif not char.islower():
            of[byte] = 5
    return of


_CLASS_OF = _classes()


def terms_of(text: bytes) -> np.ndarray:
    """Term counts of one text."""
    counts = np.zeros(TERMS, np.float32)
    classes = _CLASS_OF[np.frombuffer(text, np.uint8)]
    if len(classes) > 1:
        counts[:-2] = np.bincount(classes[:-1] * _CLASSES + classes[1:], minlength=TERMS - 2)
    words = text.split()
    counts[-2] = sum(map(bytes.__eq__, words, words[1:]))
    counts[-1] = len(words) - sum(len(set(words[i : i + WINDOW])) for i in range(0, len(words), WINDOW))
    return counts


def _shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """Term weights, projection, labelled unit vectors, their labels, and the share of label 1 among all labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray, prior: float, dimensions: int = DIMENSIONS) -> Model:
        shares = _shares(counts)
        weights = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
        weighed = _unit(shares * weights)
        _, axes = np.linalg.eigh(weighed.T @ weighed)  # right singular vectors, largest last
        projection = np.ascontiguousarray(axes[:, ::-1][:, :dimensions], np.float32)
        return cls(weights, projection, _unit(weighed @ projection).astype(np.float32), labels.astype(np.float64), prior)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest; ties go to the earlier neighbour, no similarity gives the prior."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        vectors = _unit(_shares(counts) * self.weights @ self.projection)
        near = np.round((vectors @ self.vectors.T).astype(np.float64), 6)
        near -= np.arange(len(self.labels)) * 1e-12
        k = min(neighbours, len(self.labels))
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        force = np.maximum(np.take_along_axis(near, best, axis=1), 0) ** SHARPNESS
        total = force.sum(axis=1)
        voted = (force * self.labels[best]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.round(np.where((total > 0) & counts.any(axis=1), np.clip(voted, 0, 1), self.prior), 9)


def terms_column(text: Column) -> Column:
    @arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in slices(batches):
            yield pa.array([terms_of(t) for t in utf8(part)], pa.list_(pa.float32()))

    return run(text)


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: CRC-32 of the id as text divisible by five. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Model from the labelled rows that are not held out.

    At most ``per_class`` documents of each label are used, those with the smallest hash of
    their id; rows without id or label are left out, and of several labels of a document the
    majority counts (ties: 1). Without labelled rows every score is 0.5.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    prior = known.agg(F.avg("quality")).first()[0]
    chosen = [
        known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for label in (0, 1)
    ]
    sample = chosen[0].unionByName(chosen[1]).alias("s")  # at most 2 * per_class ids
    texts = docs.select("doc_id", "text").alias("d").join(F.broadcast(sample), F.col("d.doc_id") == F.col("s.doc_id"))
    picked = texts.select("d.doc_id", "s.quality", "d.text").dropDuplicates(["doc_id"])
    rows = picked.select("doc_id", "quality", terms_column(F.col("text")).alias("terms")).toArrow().sort_by("doc_id")
    counts = rows["terms"].combine_chunks().flatten().to_numpy().reshape(-1, TERMS)
    return Model.fit(counts, rows["quality"].to_numpy(), 0.5 if prior is None else float(prior))


def score(docs: DataFrame, model: Model) -> Column:
    """Score of ``docs.text`` from 0 to 1; null or empty text gets the share of label 1 among all labels."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in slices(batches):
            yield pa.array(shared.value.scores(np.array([terms_of(t) for t in utf8(part)])), pa.float64())

    return run(docs["text"])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``; other columns are not read.

    Only the text makes a score. Null ids, repeated rows and ties change nothing: every row
    is scored by itself. Empty table: no rows.
    """
    rows = docs.select("doc_id", "text")
    marked = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(rows, fit(docs, labels)).alias("score"))
    return marked.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, all columns kept."""
    return docs.where(score(docs, fit(docs, labels)) >= threshold)
