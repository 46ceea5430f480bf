"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Principal axes and a learned rotation turn a vector into a 64-bit code. The code is cut into
substrings with a bucket table each. Codes within radius r agree with the query up to r // m bits
in at least one of m substrings, so probing those buckets retrieves every code within the
radius; the codes are checked, and the vectors behind them reranked by exact distance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import stage

K = 10
QUERY_EVERY = 100
#: Vectors that axes, rotation and radius are learned on, at most; the index holds all.
SAMPLE = 4096
SAMPLE_QUERIES = 256
#: Share of true neighbours in the sample that the radius must cover.
COVER = 0.985
BITS = 64
SUBSTRINGS = 8
ROTATIONS = 30
#: Rows of an index block and of a query block; two blocks meet in one task.
INDEX_ROWS = 8192
QUERY_ROWS = 2048
LEAST_BLOCKS = 32

_DIFFER = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
#: By number of bits and value of a substring: the values that differ in at most so many bits.
_PROBES = [[np.flatnonzero(row <= bits).tolist() for row in _DIFFER] for bits in range(9)]


@dataclass
class Codes:
    """Centre and projection to ``BITS`` signs, and the radius to search."""

    centre: np.ndarray
    projection: np.ndarray
    radius: int

    @classmethod
    def learn(cls, vectors: np.ndarray, k: int = K, seed: int = 7) -> Codes:
        """Iterative quantisation: rotate the principal axes until signs lose least; short vectors get random axes besides."""
        size = vectors.shape[1]
        random = np.random.default_rng(seed)
        centre = vectors.mean(axis=0)
        moved = vectors - centre
        _, axes = np.linalg.eigh(moved.T @ moved)
        axes = axes[:, ::-1][:, :BITS]
        flat = moved @ axes
        rotation = np.linalg.qr(random.standard_normal((axes.shape[1], axes.shape[1])))[0]
        for _ in range(ROTATIONS):
            u, _, vt = np.linalg.svd(np.where(flat @ rotation > 0, 1.0, -1.0).T @ flat)
            rotation = (u @ vt).T
        projection = axes @ rotation
        if size < BITS:
            projection = np.hstack([projection, random.standard_normal((size, BITS - size))])
        codes = cls(centre, projection, BITS)
        codes.radius = codes._cover(vectors, k)
        return codes

    def of(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits((vectors - self.centre) @ self.projection > 0, axis=1, bitorder="little").view("<u8").ravel()

    def _cover(self, vectors: np.ndarray, k: int) -> int:
        """Smallest radius that holds ``COVER`` of the sample's true neighbours."""
        codes, found = self.of(vectors), []
        norms = (vectors**2).sum(axis=1)
        for i in range(min(SAMPLE_QUERIES, len(vectors))):
            away = norms - 2 * (vectors @ vectors[i])
            away[i] = np.inf
            nearest = np.argsort(away)[: min(k, len(vectors) - 1)]
            found += np.bitwise_count(codes[nearest] ^ codes[i]).tolist()
        return int(np.quantile(found, COVER, method="higher")) if found else BITS


class Buckets:
    """The codes of a block in one bucket table per substring: rows sorted by the substring's value, and where each value starts."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        parts = np.ascontiguousarray(codes)[:, None].view(np.uint8)
        self.rows = [np.argsort(parts[:, s], kind="stable") for s in range(SUBSTRINGS)]
        self.starts = [np.concatenate(([0], np.cumsum(np.bincount(parts[:, s], minlength=256)))) for s in range(SUBSTRINGS)]

    def within(self, query: np.uint64, radius: int) -> np.ndarray:
        """Rows with at most ``radius`` different bits, in order; only the probed buckets are read."""
        seen = np.zeros(len(self.codes), bool)
        for s in range(SUBSTRINGS):
            rows, starts = self.rows[s], self.starts[s]
            value = int(query) >> (8 * s) & 255
            for bucket in _PROBES[min(radius // SUBSTRINGS, 8)][value]:
                seen[rows[starts[bucket] : starts[bucket + 1]]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ query) <= radius]


def candidates(codes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Which rows (columns of the result) lie within the radius of which queries, by substring buckets."""
    buckets, close = Buckets(codes), np.zeros((len(queries), len(codes)), bool)
    for q, query in enumerate(queries):
        close[q, buckets.within(query, radius)] = True
    return close


def nearest_in_block(model: Codes, ids, vectors: np.ndarray, query_ids, queries: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of the ``k`` nearest found for each query; the radius grows where it holds fewer."""
    buckets, asked = Buckets(model.of(vectors)), model.of(queries)
    out = []
    todo, radius = np.arange(len(queries)), model.radius
    known = np.array([-1 if i is None else i for i in ids], np.int64)
    none = np.array([i is None for i in ids], bool)
    while len(todo):
        short = []
        for q in todo:
            near = buckets.within(asked[q], radius)
            rows = near[none[near] | (known[near] != query_ids[q])]
            if len(rows) < k and radius < BITS:
                short.append(q)
                continue
            away = np.sqrt(((vectors[rows] - queries[q]) ** 2).sum(axis=1))
            best = np.lexsort((known[rows], none[rows], away))[:k]
            out += [(query_ids[q], ids[rows[b]], float(away[b])) for b in best]
        todo, radius = np.array(short, np.int64), min(BITS, radius + SUBSTRINGS)
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows that take part.

    Null or zero vectors and such with null or non-finite parts don't, nor do vectors of another
    length than most have, as they have no distance to the others.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("v").isNotNull()).where(fine)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else -1))


def search(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found for every row whose id is divisible by ``every``.

    All rows are candidates but those with the query's own id; ties go to the smaller id,
    null ids last. A query gets fewer only where fewer rows take part. Rows meet queries in
    blocks of bounded size, dealt by a hash of the whole row, so copies are spread; each
    block returns its best ``k``. Repeated rows are candidates of their own, a repeated query
    is answered once. Other columns are not read; empty table: no rows.
    """
    rows = stage(usable(vectors), "vectors")
    total = rows.count()
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    sample = rows.orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    if not len(sample):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = Codes.learn(sample.flatten().to_numpy().reshape(len(sample), -1), k)
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    blocks = max(LEAST_BLOCKS, total // INDEX_ROWS + 1)
    query_blocks = asked.count() // QUERY_ROWS + 1
    own = F.xxhash64("vec_id", "v")

    def dealt(frame: DataFrame, mine: int, others: int, query: bool) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        placed = frame.select("vec_id", "v", F.pmod(own, F.lit(mine)).cast("int").alias("mine"), other.alias("other"))
        i, q = ("other", "mine") if query else ("mine", "other")
        return placed.select(F.col(i).alias("i"), F.col(q).alias("q"), F.lit(query).alias("query"), "vec_id", "v")

    def meet(block: pa.Table) -> pa.Table:
        matrix = block["v"].combine_chunks().flatten().to_numpy().reshape(block.num_rows, -1)
        query = block["query"].to_numpy(zero_copy_only=False).astype(bool)
        ids = block["vec_id"].to_pylist()
        index_ids = [x for x, is_query in zip(ids, query) if not is_query]
        query_ids = [x for x, is_query in zip(ids, query) if is_query]
        found = nearest_in_block(shared.value, index_ids, matrix[~query], query_ids, matrix[query], k) if query_ids else []
        columns = list(zip(*found)) or [()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    both = dealt(rows, blocks, query_blocks, False).unionByName(dealt(asked, query_blocks, blocks, True))
    found = both.groupBy("i", "q").applyInArrow(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
