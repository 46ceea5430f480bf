"""Keep one row per key.

Each operator is ``row_number() == 1``, for which Spark adds a window group limit: every map
task keeps only its own best row per key before the shuffle, so a key that holds a third of
the table costs one row per task and never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")


def keep_latest(
    df: DataFrame, key: str = "source_id", date: str = "fct_dt", tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """The row with the latest ``date`` per ``key``.

    Equal dates are settled by ``tie_breakers`` (default: every other column in schema
    order), so the survivor does not depend on how the data was split.
    """
    rest = [c for c in df.columns if c not in (key, date)] if tie_breakers is None else list(tie_breakers)
    return keep_first(df, [key], [F.col(date).desc(), *(F.col(c).asc() for c in rest)])


def distinct_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Distinct by key with a fixed survivor instead of an arbitrary one."""
    return keep_first(df, keys, order)


def nearest_by(df: DataFrame, key: str, separation: str, tie_breaker: str) -> DataFrame:
    """The row with the smallest separation per key; ties go to the smaller ``tie_breaker``."""
    return keep_first(df, [key], [F.col(separation).asc_nulls_last(), F.col(tie_breaker).asc_nulls_last()])
