"""Document fingerprints: weighted SimHash, edits against the next document, and search in permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starloom.llm.common import SLICE, hex64, signed
from starloom.session import stage

RADIUS = 3
BLOCKS = 6
#: Rows of a range of ids that one task reads in order. Above ``MOST_RANGES`` ranges they hold more rows.
RANGE_ROWS = 1024
MOST_RANGES = 8192
#: Keys of looked-up rows that may be broadcast (about 16 MB); with more, both sides are shuffled and merged.
MOST_BROADCAST = 200_000
#: Rows whose id is divisible by this are looked up in the block tables.
QUERY_EVERY = 50

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed values of the splitmix64 finaliser
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 4096


def fingerprint_of(text: bytes) -> int:
    """Weighted SimHash of 64 bits, unsigned; a text without words gives zero.

    Terms are pairs of neighbouring words (A-Z lower-cased, split at ASCII white space; the
    word itself if it is the only one). A term that occurs n times weighs 1 + ln n, kept in
    sixteenths; its hash votes with that weight for or against every bit, and a bit is one
    where the votes are above zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    terms = hashes if len(hashes) == 1 else hashes[:-1] * _STEP + hashes[1:]
    terms ^= terms >> np.uint64(30)
    terms *= _MIX[0]
    terms ^= terms >> np.uint64(27)
    terms *= _MIX[1]
    terms ^= terms >> np.uint64(31)
    terms, times = np.unique(terms, return_counts=True)
    weights = np.rint(16 * (1 + np.log(times))).astype(np.float32)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(terms), _CHUNK):  # sums of a chunk are whole numbers below 2 ** 24
        bits = np.unpackbits(terms[i : i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        part = weights[i : i + _CHUNK]
        votes += (2 * (part @ bits.astype(np.float32)) - part.sum()).astype(np.int64)
    return int(np.packbits(votes > 0, bitorder="little").view("<u8")[0])


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def likeness(a: int, b: int) -> float:
    """Share of equal bits."""
    return 1 - (a ^ b).bit_count() / 64


# --- fingerprints of neighbouring documents ---------------------------------------------


def with_next(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fp``, ``edited_fp``, ``near_edited``, ``near_next``.

    The next row is that with the next larger ``doc_id`` (null first, ties by a hash of the
    text), after the last comes the first; an only row follows itself. Null text is empty.
    Ids are cut into ranges of about ``RANGE_ROWS`` rows; the texts are shuffled once by range and
    read in order, and the first row of each range also goes to the range before it.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id")
    rows = ids.count()
    ranges = min(MOST_RANGES, rows // RANGE_ROWS + 1)
    cuts = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges + 1000)).first()[0]
    cuts = np.unique(np.array(cuts if ranges > 1 and cuts else [], np.int64))

    def range_of(values: pa.Array) -> np.ndarray:
        """0 for null, 1 and up for the ranges between the cuts."""
        found = 1 + np.searchsorted(cuts, values.fill_null(0).to_numpy(zero_copy_only=False), side="left")
        return np.where(values.is_null().to_numpy(zero_copy_only=False), 0, found).astype(np.int32)

    @arrow_udf("int")
    def placed(values: pa.Array) -> pa.Array:
        return pa.array(range_of(values), pa.int32())

    # one row per range
    firsts = ids.select(placed("doc_id").alias("range"), "doc_id").groupBy("range").agg(F.min("doc_id").alias("first")).collect()
    first = {r["range"]: r["first"] for r in firsts}
    order = sorted(first)
    before = {r: order[i - 1] for i, r in enumerate(order)}

    @arrow_udf("array<struct<range:int,copy:boolean>>")
    def places(values: pa.Array) -> pa.Array:
        out = []
        for r, value in zip(range_of(values).tolist(), values.to_pylist()):
            here = [{"range": r, "copy": False}]
            out.append([*here, {"range": before[r], "copy": True}] if value == first[r] else here)
        return pa.array(out, pa.list_(pa.struct([("range", pa.int32()), ("copy", pa.bool_())])))

    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.explode(places("doc_id")).alias("p"))
    in_order = (
        dealt.select("p.range", "p.copy", "doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartition("range")
        .sortWithinPartitions("range", "copy", F.col("doc_id").asc_nulls_first(), "tie")
        .drop("tie")
    )
    kind = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one
        for batch in batches:
            out: list[tuple] = []
            for i in range(0, batch.num_rows, SLICE):
                for where, copy, doc_id, text in zip(*(c.to_pylist() for c in batch.slice(i, SLICE).columns)):
                    fp = fingerprint_of(text.encode())
                    if held is not None and held[0] == where:
                        out.append(_finished(*held[1:], text, fp))
                    held = None if copy else (where, doc_id, text, fp)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, _TYPES)], _NAMES)

    return in_order.mapInArrow(read, kind)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def _finished(doc_id, text: str, fp: int, next_text: str, next_fp: int) -> tuple:
    changed = edited(text, next_text).encode()
    changed_fp = fingerprint_of(changed)
    sha = hashlib.sha256(changed).hexdigest()
    return doc_id, len(text), sha, signed(fp), signed(changed_fp), likeness(fp, changed_fp), likeness(fp, next_fp)


# --- permuted block tables --------------------------------------------------------------


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """64 bits cut into blocks of nearly equal length."""
    ends = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(ends, ends[1:])]


def _tables(fp: Column, radius: int, blocks: int) -> Column:
    """The keys of a fingerprint: for each choice of ``blocks - radius`` blocks, a hash of the choice and their bits."""
    masks = block_masks(blocks)
    chosen = [sum(masks[b] for b in c) for c in combinations(range(blocks), blocks - radius)]
    return F.array(*(F.struct(F.lit(signed(m)).alias("mask"), F.xxhash64(F.lit(signed(m)), fp.bitwiseAND(F.lit(signed(m)))).alias("key")) for m in chosen))


def _first_table(differ: Column, radius: int, blocks: int) -> Column:
    """Mask of the first ``blocks - radius`` blocks without a difference: the one table a pair is taken from."""
    mask, taken = F.lit(0).cast("long"), F.lit(0)
    for m in block_masks(blocks):
        take = (differ.bitwiseAND(F.lit(signed(m))) == 0) & (taken < blocks - radius)
        mask = F.when(take, mask.bitwiseOR(F.lit(signed(m)))).otherwise(mask)
        taken = F.when(take, taken + 1).otherwise(taken)
    return mask


def within(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (``q``, ``fp``) of a fingerprint of ``queries.fp`` and one of ``index.fp`` with at most ``radius`` different bits.

    Fingerprints within the radius agree in at least ``blocks - radius`` blocks, so there
    is a table for each such choice of blocks, and equal keys meet. Every pair is found, and
    found once: in the table of the first blocks that agree. Both sides hold a fingerprint once.
    """
    left = queries.select(F.col("fp").alias("q")).select("q", F.explode(_tables(F.col("q"), radius, blocks)).alias("t"))
    right = index.select("fp", F.explode(_tables(F.col("fp"), radius, blocks)).alias("t"))
    asked = left.select("q", "t.key", "t.mask")
    if queries.count() * comb(blocks, radius) > MOST_BROADCAST:
        asked = asked.hint("merge")  # the planner's estimate doesn't see the copies made by explode
    pairs = right.select("fp", "t.key").join(asked, "key")
    differ = F.col("q").bitwiseXOR(F.col("fp"))
    near = pairs.where(F.bit_count(differ) <= radius)
    return near.where(_first_table(differ, radius, blocks) == F.col("mask")).select("q", "fp")


def fingerprinted(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``with_next`` with hexadecimal fingerprints, and ``n_near`` for every row whose id is divisible by ``QUERY_EVERY``.

    ``n_near`` counts the other rows with at most ``radius`` different bits and is null for
    rows that are not looked up. Repeated rows are kept; empty table: no rows; other columns are
    not read.
    """
    rows = stage(with_next(docs.select("doc_id", "text")), "fingerprints")
    counts = rows.groupBy("fp").agg(F.count("*").alias("n"))
    asked = rows.where(F.col("doc_id") % QUERY_EVERY == 0).select("fp").distinct()
    found = within(asked, counts, radius).join(counts, "fp").groupBy("q").agg((F.sum("n") - 1).alias("near"))
    near = F.when(F.col("doc_id") % QUERY_EVERY == 0, F.col("near"))
    return rows.join(found, F.col("fp") == F.col("q"), "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex64(F.col("fp")).alias("fingerprint"),
        hex64(F.col("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        near.alias("n_near"),
    )
