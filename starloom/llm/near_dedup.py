"""SimHash near-dedup through a segment-popcount embedding.

A 64-bit fingerprint is cut into short segments and mapped to the vector of their bit
counts. The Manhattan distance of two such vectors never exceeds the Hamming distance of
the fingerprints, so a grid range-join under that distance finds every pair worth an exact
comparison. Bit counts are kept as a thermometer code (a segment of ``w`` bits with ``p``
set becomes ``p`` ones), in which the Manhattan distance is again an XOR and a bit count.

Grid: the segments are dealt into ``radius + zeros`` groups of coordinates. Where the
Manhattan distance is at most ``radius``, at least ``zeros`` groups agree in every
coordinate, so for each choice of ``zeros`` groups there is one unit grid, and the pair
shares a cell of at least one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starloom.llm.common import hex64, signed, slices, utf8
from starloom.llm.components import apart, connected_components
from starloom.session import stage

SHINGLE_WORDS = 4
RADIUS = 4
SEGMENT_BITS = 2
#: Cells with more points are split into blocks that are compared pair by pair of blocks.
BLOCK = 4096
#: Up to this size all points of a cell are compared in one vectorised pass.
SMALL_CELL = 16


def fingerprint_of(text: bytes, words: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """Majority SimHash of the word shingles, as a signed long; no words give zero.

    A-Z are lower-cased; words end at ASCII white space; a text with fewer words is one shingle.
    """
    hashes = shingle_hashes(text, words, seed)
    return signed(majority(hashes)) if len(hashes) else 0


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS, seed: int = 42) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[i:j], seed) for i, j in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist())
        ]
    return np.array(hashes, np.uint64)


def majority(hashes: np.ndarray, chunk: int = 1 << 15) -> int:
    """The number whose bits are set in over half of ``hashes``."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), chunk):
        octets = hashes[i : i + chunk].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    won = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(won.view("<u8")[0])


def shingle_fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """``fingerprint_of`` as a column."""

    @arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in slices(batches):
            yield pa.array([fingerprint_of(t, words) for t in utf8(part)], pa.int64())

    return run(text)


# --- embedding and grid -----------------------------------------------------------------


def thermometer(bits: Column, width: int = SEGMENT_BITS) -> Column:
    """Bit counts of all segments of 1, 2 or 4 bits, each as a run of ones in its own segment."""
    if width == 1:
        return bits
    low = F.lit(signed(0x5555555555555555))
    x, y = bits.bitwiseAND(low), F.shiftrightunsigned(bits, 1).bitwiseAND(low)
    either, both = x.bitwiseOR(y), x.bitwiseAND(y)
    code = F.shiftleft(both, 1).bitwiseOR(either)
    if width == 2:
        return code
    if width != 4:
        raise ValueError("segments have 1, 2 or 4 bits")
    # merge two two-bit runs: sort the four bits of the segment with a small network
    for step, mask in ((2, 0x3333333333333333), (1, 0x2222222222222222)):
        m = F.lit(signed(mask))
        p, q = code.bitwiseAND(m), F.shiftrightunsigned(code, step).bitwiseAND(m)
        rest = code.bitwiseAND(F.bitwise_not(m.bitwiseOR(F.lit(signed((mask << step) & ((1 << 64) - 1))))))
        code = rest.bitwiseOR(p.bitwiseOR(q)).bitwiseOR(F.shiftleft(p.bitwiseAND(q), step))
    return code


def thermometer_np(bits: np.ndarray, width: int = SEGMENT_BITS) -> np.ndarray:
    """The same for an array of unsigned numbers, by table-free counting of each segment."""
    if width == 1:
        return bits
    out = np.zeros_like(bits)
    part = np.uint64((1 << width) - 1)
    for at in range(0, 64, width):
        counts = np.bitwise_count((bits >> np.uint64(at)) & part).astype(np.uint64)
        out |= ((np.uint64(1) << counts) - np.uint64(1)) << np.uint64(at)
    return out


def grids(radius: int, zeros: int, width: int = SEGMENT_BITS) -> list[int]:
    """One mask over the thermometer code for each choice of ``zeros`` groups."""
    segments = 64 // width
    groups = radius + zeros
    masks = [0] * groups
    for s in range(segments):
        masks[s * groups // segments] |= ((1 << width) - 1) << (s * width)
    return [sum(masks[g] for g in chosen) for chosen in combinations(range(groups), zeros)]


def zeros_for(points: int, radius: int, width: int = SEGMENT_BITS, cell: int = 512) -> int:
    """Groups that must agree so that an average cell stays below ``cell`` points. Any choice finds the same pairs.

    The bit count of a random segment of 1, 2 or 4 bits carries about 1, 1.5 or 2 bits.
    """
    bits = 64 // width * {1: 1.0, 2: 1.5, 4: 2.03}[width]
    zeros = 2
    while zeros < 6 and points / 2 ** (bits * zeros / (radius + zeros)) > cell and comb(radius + zeros + 1, radius) < 300:
        zeros += 1
    return zeros


def in_blocks(cells: DataFrame, spread: Column) -> DataFrame:
    """``cells`` with cells above ``BLOCK`` rows cut into blocks by ``spread``: every two blocks of a cell are a cell of their own."""
    crowded = stage(cells.groupBy("cell").count().where(F.col("count") > BLOCK), "crowded-cells")
    blocks = F.ceil(F.col("count") / BLOCK).cast("long")
    own, zero = F.pmod(spread, blocks), F.lit(0).cast("long")
    others = F.when(F.col("count").isNull(), F.array(zero)).otherwise(F.sequence(zero, blocks - 1))
    pair = F.xxhash64("cell", F.least(own, "other"), F.greatest(own, "other"))
    return (
        cells.join(crowded, "cell", "left")
        .withColumn("other", F.explode(others))
        .withColumn("cell", F.when(F.col("count").isNull(), F.col("cell")).otherwise(pair))
        .select(*["cell", *(c for c in cells.columns if c != "cell")])
    )


def links(points: DataFrame, fingerprint: str, radius: int = RADIUS, width: int = SEGMENT_BITS) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints with at most ``radius`` different bits.

    ``points`` holds each fingerprint once. The pairs connect exactly what all such pairs
    connect, but a cell of many mutual neighbours gives a spanning forest and not all its
    pairs. Cells above ``BLOCK`` points are cut into blocks and every two blocks meet in a
    task of their own, so no task holds more than two blocks of a cell.
    """
    zeros = zeros_for(points.count(), radius, width)
    code = thermometer(F.col("fp"), width)
    cells = points.select(F.col(fingerprint).alias("fp")).select(
        "fp",
        F.explode(
            F.array(*(F.xxhash64(F.lit(i), code.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(grids(radius, zeros, width))))
        ).alias("cell"),
    )
    placed = in_blocks(cells, F.xxhash64("fp"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = fp = np.empty(0, np.int64)
        for batch in batches:
            cell = np.concatenate((cell, batch.column(0).to_numpy()))
            fp = np.concatenate((fp, batch.column(1).to_numpy()))
            if not len(cell):
                continue
            whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            yield _pairs(cell[:whole], fp[:whole], radius, width)
            cell, fp = cell[whole:], fp[whole:]
        yield _pairs(cell, fp, radius, width)

    sorted_cells = placed.repartition("cell").sortWithinPartitions("cell", "fp")
    return sorted_cells.mapInArrow(meet, "a long, b long")


def _pairs(cell: np.ndarray, fp: np.ndarray, radius: int, width: int) -> pa.RecordBatch:
    """Links within the cells of a sorted run of points."""
    bits = fp.astype(np.int64).view(np.uint64)
    code = thermometer_np(bits, width)
    n = len(cell)
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if n else np.empty(0, np.int64)
    sizes = np.diff(np.concatenate((starts, [n])))
    a, b = [], []
    first = np.flatnonzero(np.repeat(sizes <= SMALL_CELL, sizes)) if n else starts
    ends = np.repeat(starts + sizes, sizes)
    for lag in range(1, SMALL_CELL):
        first = first[first + lag < ends[first]]
        if not len(first):
            break
        near = first[np.bitwise_count(code[first] ^ code[first + lag]) <= radius]
        near = near[np.bitwise_count(bits[near] ^ bits[near + lag]) <= radius]
        a.append(bits[near])
        b.append(bits[near + lag])
    for s, size in zip(starts[sizes > SMALL_CELL], sizes[sizes > SMALL_CELL]):
        _forest(bits[s : s + size], code[s : s + size], radius, a, b)
    empty = [np.empty(0, np.uint64)]
    ends_a, ends_b = np.concatenate(a or empty).view(np.int64), np.concatenate(b or empty).view(np.int64)
    keep = ends_a != ends_b
    return pa.RecordBatch.from_arrays([pa.array(ends_a[keep]), pa.array(ends_b[keep])], ["a", "b"])


def _forest(bits: np.ndarray, code: np.ndarray, radius: int, a: list, b: list) -> None:
    """Breadth-first trees: each point is compared with the points that no tree holds yet."""
    while len(bits):
        reached, bits, code = [(bits[0], code[0])], bits[1:], code[1:]
        while reached and len(bits):
            point, its_code = reached.pop()
            near = np.bitwise_count(code ^ its_code) <= radius
            near[near] = np.bitwise_count(bits[near] ^ point) <= radius
            if near.any():
                found = bits[near]
                a.append(np.full(len(found), point))
                b.append(found)
                reached.extend(zip(found, code[near]))
                bits, code = bits[~near], code[~near]


# --- documents --------------------------------------------------------------------------


def fingerprint_roots(marked: DataFrame, radius: int = RADIUS, width: int = SEGMENT_BITS) -> DataFrame:
    """(``fp``, ``root``) for every fingerprint of ``marked.fp``: ``root`` is one fingerprint of its component."""
    points = stage(marked.select("fp").distinct(), "fingerprints")
    edges = stage(links(points, "fp", radius, width).distinct(), "near-links")
    roots = connected_components(edges, label="near")
    return points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_components(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (hex), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over fingerprints with at
    most ``radius`` different bits. Null or empty texts have fingerprint zero and are linked
    like any other; rows with equal fingerprints share a component; repeated rows are kept; a
    null ``doc_id`` is no candidate for the smallest, and a component without any id has null.
    Empty table: no rows. Other columns of ``docs`` are not read.
    """
    marked = stage(docs.select("doc_id", shingle_fingerprint(F.col("text"), words).alias("fp")), "simhash")
    roots = stage(fingerprint_roots(marked, radius), "near-roots")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = first.join(roots, "fp")
    smallest = apart(named.groupBy("root").agg(F.min("first").alias("component_id")))
    names = stage(roots.join(smallest, "root").select("fp", "component_id"), "near-names")
    return marked.join(names, "fp", "left").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")
