"""Mixing sources to target weights by repetition rates and a hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import stage

WEIGHTS = (5, 2, 1)
#: No source, and so no document, is repeated more often than this.
MAX_RATE = 3
SEED = 20260901
#: ASCII white space ends a word.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the values only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double") * F.lit(2.0**-53)


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point, null last.

    A range sort spreads the names over tasks, and only one count per task is summed up.
    """
    placed = stage(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumns({"task": F.spark_partition_id(), "place": F.monotonically_increasing_id()}),
        "mix-ranks",
    )
    runs = placed.groupBy("task").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    runs = runs.select("task", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return placed.join(runs, "task").select("source", "words", (F.col("place") - F.col("first") + F.col("start")).alias("rank"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """(``source``, ``source_size``, ``target``, ``rate``) from rows of (``source``, ``size``).

    The weights repeat over the sources in code-point order and share the sum of all sizes. A
    target stops at ``max_rate`` times its source, and the excess is shared by weight among
    the others until none is above: all targets are ``min(max_rate * size, level * weight)``,
    and each round raises the level from three sums until it stands still. A source without
    words has target and rate 0. No rows: no sources.
    """
    sources = stage(sizes.groupBy("source").agg(F.sum("size").alias("words")), "mix-sources")
    choice = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = stage(_ranked(sources).select("source", "words", choice.alias("weight")), "mix-weights")
    cap = F.col("words") * F.lit(float(max_rate))
    total, level = float(weighed.agg(F.sum("words")).first()[0] or 0), 0.0
    while True:
        above = cap < F.lit(level) * F.col("weight")
        full, free = weighed.agg(
            F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        if not free or (risen := (total - full) / free) <= level:
            break
        level = risen
    target = F.least(cap, F.lit(level) * F.col("weight"))
    rate = F.when(F.col("words") > 0, F.least(target / F.col("words"), F.lit(float(max_rate)))).otherwise(0.0)
    return stage(
        weighed.select("source", F.col("words").alias("source_size"), target.alias("target"), rate.alias("rate")), "mix-targets"
    )


def copies(rate: Column, chance: Column) -> Column:
    """``floor(rate)`` copies and one more with the fraction as probability."""
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, seed: int = SEED) -> DataFrame:
    """The documents of the mix: every row as often as its source's rate says, all columns kept.

    Size is the number of words, null text counts 0; a null source is a source. The extra
    copy is decided by a hash of ``doc_id``, text and seed, so reruns and retried tasks agree,
    and repeated rows are decided alike. The targets have one row per source; the join splits
    a hot source on the documents' side. Empty table: no rows.
    """
    targets = source_targets(docs.select("source", word_count(F.col("text")).alias("size")), weights, max_rate).alias("t")
    d = docs.alias("d")
    joined = d.join(targets, F.col("d.source").eqNullSafe(F.col("t.source")))
    times = copies(F.col("t.rate"), draw(F.col("d.doc_id"), F.col("d.text"), seed=seed))
    again = F.explode(F.sequence(F.lit(1).cast("long"), times))
    return joined.where(times > 0).select("d.*", again.alias("__copy")).select(*(F.col(f"`{c}`") for c in docs.columns))


def taken_words(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words the mix takes of it)."""
    sized = stage(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed=seed).alias("chance")),
        "mix-sizes",
    )
    targets = source_targets(sized.select("source", "size"), weights, max_rate).alias("t")
    s = sized.alias("s")
    taken = F.col("s.size") * copies(F.col("t.rate"), F.col("s.chance"))
    return s.join(targets, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.doc_id", "s.size", "t.source_size", "t.target", taken.alias("taken")
    )
