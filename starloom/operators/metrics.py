"""Statistics of a run, taken while its rows pass by."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, write: Callable[[DataFrame], object], metrics: Mapping[str, Column] | None = None) -> dict[str, object]:
    """Run ``write`` on ``df`` and return ``n_records`` and the given aggregates of the rows it wrote.

    The aggregates are computed inside the write, without a second pass over the data.
    """
    seen = Observation()
    wanted = {"n_records": F.count("*"), **(metrics or {})}
    write(df.observe(seen, *(c.alias(name) for name, c in wanted.items())))
    return dict(seen.get)
