"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch whose words repeat with a smallest period and that no neighbouring word
extends. Its last two periods are a square at which the suffixes one period apart part
company after exactly one period: a branching tandem. Those are found on the suffix array
alone: every place where its LCP array has a minimum splits an interval in two, the
suffixes of the smaller side look up their neighbours one period (the LCP value) before
and behind in the inverse suffix array, and a neighbour on the other side makes a tandem.
Each suffix is on a smaller side at most log n times, so there are no tree nodes and no pairs.
Tandems are rotated to the left as far as words agree, and those of one stretch merge into
the run with the smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import slices, utf8

#: A run has so many words and so many periods at least.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Suffixes that are looked up at a time.
AT_ONCE = 1 << 18

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``ids``, and per k the ranks of all stretches of 2**k (those cut off by the end have ranks of their own)."""
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    ranks = [rank.astype(np.int32)]
    order = np.argsort(ranks[0], kind="stable")
    step = 1
    while n and ranks[-1].max() < n - 1:
        behind = np.zeros(n, np.int64)
        behind[: n - step] = ranks[-1][step:] + 1
        key = ranks[-1].astype(np.int64) * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, np.int32)
        rank[order] = new
        ranks.append(rank)
        step *= 2
    return order, ranks


def common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes ``a`` and ``b``."""
    n, length = len(ranks[0]), np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = a + length, b + length
        inside = (i < n) & (j < n)
        same = inside & (ranks[k][np.minimum(i, n - 1)] == ranks[k][np.minimum(j, n - 1)])
        length += same.astype(np.int64) << k
    return length


def rotated(ranks: list[np.ndarray], start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The starts moved left as long as the word before equals the one a period behind it."""
    start = start.copy()
    for k in range(len(ranks) - 1, -1, -1):
        before = start - (1 << k)
        # ranks of a stretch that runs over the end are its own, and such a stretch never lies before a tandem
        at = np.maximum(before, 0)
        same = (before >= 0) & (ranks[k][at] == ranks[k][at + period])
        start[same] = before[same]
    return start


def splits(lcp: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the LCP array the first suffix of its left side and the last one of its right side.

    ``lcp[k]`` belongs to the suffixes k - 1 and k. Its left side holds larger values only, its
    right side may repeat it, so that every two suffixes are parted at one place.
    """
    n = len(lcp)
    left, right, open_ = [0] * n, [n - 1] * n, []
    for k in range(1, n):
        value = lcp[k]
        while open_ and lcp[open_[-1]] > value:
            right[open_.pop()] = k - 1
        left[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.array(left, np.int64), np.array(right, np.int64)


def tandems(order: np.ndarray, lcp: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all branching tandems with periods up to ``longest``."""
    n = len(order)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    left, right = splits(lcp.tolist())
    place = np.flatnonzero((lcp >= 1) & (lcp <= longest))
    left_size, right_size = place - left[place], right[place] - place + 1
    on_left = left_size <= right_size
    size = np.where(on_left, left_size, right_size)
    first = np.where(on_left, left[place], place)
    other_low = np.where(on_left, place, left[place])
    other_high = np.where(on_left, right[place], place - 1)
    ends = np.cumsum(size)
    found = []
    at = 0
    while at < len(place):
        till = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        part = slice(at, till)
        which = np.repeat(np.arange(at, till), size[part])
        offset = np.arange(len(which)) - np.repeat(ends[part] - size[part] - (ends[at] - size[at]), size[part])
        suffix, period = order[first[which] + offset], lcp[place[which]]
        for sign in (1, -1):
            other = suffix + sign * period
            inside = (other >= 0) & (other < n)
            where = inverse[np.clip(other, 0, n - 1)]
            hit = inside & (where >= other_low[which]) & (where <= other_high[which])
            found.append((np.minimum(suffix, other)[hit], period[hit]))
        at = till
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def runs_of(ids: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, length, period) of all runs, by start and period."""
    none = np.empty((0, 3), np.int64)
    n = len(ids)
    if n < max(least_words, 2):
        return none
    order, ranks = suffix_order(ids)
    # a run of least_words words and least_periods periods repeats a stretch of this length
    if 1 << (len(ranks) - 1) <= least_words - least_words // least_periods:
        return none
    lcp = np.zeros(n, np.int64)
    lcp[1:] = common_prefixes(ranks, order[:-1], order[1:])
    start, period = tandems(order, lcp, n // least_periods)
    end = start + 2 * period
    start = rotated(ranks, start, period)
    length = end - start
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    found = np.column_stack((start, length, period))[new]
    found = found[found[:, 1] >= np.maximum(least_words, least_periods * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those that no run holds behind its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) == 0


def analysed(text: bytes, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> tuple[int, np.ndarray, bytes]:
    """Number of words, runs, and the kept words joined by one space."""
    words = text.split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    runs = runs_of(ids, least_words, least_periods)
    if len(runs):
        kept = kept_words(len(words), runs)
        words = [w for w, stays in zip(words, kept.tolist()) if stays]
    return len(ids), runs, b" ".join(words)


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs``, ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, told apart byte by byte. ``collapsed`` holds the words
    that no run contains behind its first period. Null and empty texts have no words and an empty
    ``collapsed``; repeated rows and null ids are kept; other columns are not read; empty table: no rows.
    A text is handled in one task in memory that grows as n log n of its words; there is no shuffle.
    """
    if least_words < least_periods or least_periods < 2:
        raise ValueError("runs have two periods at least, and a word in each")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts, runs, collapsed = zip(*(analysed(t, least_words, least_periods) for t in utf8(part.column(1))))
            sizes = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
            columns = np.concatenate(runs)
            spans = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], fields=list(_RUN))
            made = [
                part.column(0),
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "n_words", "runs", "collapsed"])

    key = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {key}, {SCHEMA}")


def strongest(runs: Column) -> Column:
    """The run with the most periods, compared exactly; of equal ones the first."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document (by CRC-32 of its id) with its words from some place on repeated with a period.

    With h the checksum, g = h div 10 and n words, every word i >= a = g mod n becomes word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Other texts stay, as do texts without words or id.
    """
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(checksum / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        numbers = F.struct(a.alias("a"), p.alias("p"))
        return F.get(
            F.transform(
                F.array(numbers),
                lambda s: F.array_join(
                    F.transform(words, lambda w, i: F.when(i < s["a"], w).otherwise(F.get(words, (s["a"] + F.pmod(i - s["a"], s["p"])).cast("int")))), " "
                ),
            ),
            0,
        )

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    new = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w))), 0)
    return F.coalesce(F.when(F.pmod(checksum, F.lit(10)) == 0, new), text)
