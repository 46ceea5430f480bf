"""Keys, dates and defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.sky import as_column

# Fixed value: the date used where a job has neither a current nor a first date.
FALLBACK_DATE = "2026-06-19"

NO_MATCH = "-1"


def date_key(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """``yyyyMMdd`` with padding, so that text order is date order."""
    y, m, d = (as_column(c).cast("string") for c in (year, month, day))
    return F.concat(y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))


def business_key(*parts: Column | str) -> Column:
    """md5 over the parts joined with ``|``."""
    return F.md5(F.concat_ws("|", *(as_column(p).cast("string") for p in parts)))


def match_or_sentinel(key: Column | str, separation: Column | str, tolerance_deg: float) -> Column:
    """``key`` when the separation is within the tolerance, else ``"-1"``."""
    return F.when(as_column(separation) <= F.lit(tolerance_deg), as_column(key)).otherwise(F.lit(NO_MATCH))


def target_date(current: Column | str, genesis: Column | str) -> Column:
    """``yyyy-MM-dd`` of the current date, else the first date, else the fixed default.

    Dates, timestamps and date texts are all accepted.
    """

    def text(c: Column | str) -> Column:
        return F.substring(as_column(c).cast("string"), 1, 10)

    return F.coalesce(text(current), text(genesis), F.lit(FALLBACK_DATE))


def clip(value: Column | str, low: float, high: float) -> Column:
    return F.least(F.greatest(as_column(value), F.lit(low)), F.lit(high))
