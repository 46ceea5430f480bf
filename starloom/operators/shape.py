"""Schema checks, schema conformance and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAST_ERRORS = "_cast_errors"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


class SchemaError(ValueError):
    """A frame lacks required columns or has them with another type."""


def _widens(have: T.DataType, want: T.DataType) -> bool:
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
    if type(have) is type(want):
        return have == want
    return type(have) in order and type(want) in order and order.index(type(have)) < order.index(type(want))


def assert_schema(df: DataFrame, required: T.StructType) -> DataFrame:
    """``df`` unchanged if it has every required column in the required or a narrower type.

    Further columns are kept. The check reads the schema only.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [
        f"{f.name}: missing" if f.name not in have else f"{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}"
        for f in required.fields
        if f.name not in have or not _widens(have[f.name], f.dataType)
    ]
    if problems:
        raise SchemaError("; ".join(problems))
    return df


def _checked_cast(source: Column, have: T.DataType, want: T.DataType) -> tuple[Column, Column]:
    """The cast value and whether the cast lost something."""
    value = source.try_cast(want)
    lost = source.isNotNull() & value.isNull()
    if isinstance(want, _INTEGRAL) or (isinstance(have, _INTEGRAL) and isinstance(want, _FRACTIONAL)):
        if not isinstance(have, (T.StringType, T.BooleanType)):
            lost = lost | ~value.try_cast(have).eqNullSafe(source)
    return value, lost


def conform(df: DataFrame, target: T.StructType, on_loss: str = "fail") -> DataFrame:
    """Exactly the columns of ``target``, in its order.

    Missing columns become typed nulls, surplus ones are dropped and other types are cast.
    A cast must be lossless: 1.0 becomes the integer 1, but 1.7, an overflow or the text
    ``x`` is a loss. ``on_loss`` is ``"fail"`` (the job stops and names the column) or
    ``"mark"`` (value null, column names listed in ``_cast_errors``). Narrowing a double to
    a float is no loss.
    """
    if on_loss not in ("fail", "mark"):
        raise ValueError(f"on_loss must be fail or mark, got {on_loss}")
    have = {f.name: f.dataType for f in df.schema.fields}
    columns, marks = [], []
    for field in target.fields:
        if field.name not in have:
            columns.append(F.expr(f"CAST(NULL AS {field.dataType.simpleString()}) AS `{field.name}`"))
            continue
        source = F.col(f"`{field.name}`")
        if have[field.name] == field.dataType:
            columns.append(source)
            continue
        value, lost = _checked_cast(source, have[field.name], field.dataType)
        if on_loss == "fail":
            message = F.concat(
                F.lit(f"column {field.name}: cannot cast "), source.cast("string"), F.lit(f" to {field.dataType.simpleString()}")
            )
            value = F.when(lost, F.raise_error(message).cast(field.dataType)).otherwise(value)
        else:
            value = F.when(~lost, value)
            marks.append(F.when(lost, F.lit(field.name)))
        columns.append(value.alias(field.name))
    if on_loss == "mark":
        found = F.filter(F.array(*marks), lambda m: m.isNotNull()) if marks else F.array().cast("array<string>")
        columns.append(found.alias(CAST_ERRORS))
    return df.select(*columns)


def split_losses(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rows with at least one lossy cast) of a frame made by ``on_loss="mark"``."""
    clean = F.size(CAST_ERRORS) == 0
    return marked.filter(clean).drop(CAST_ERRORS), marked.filter(~clean)


def union_all_by_name(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    """Union by column name, duplicates kept; missing columns become null on request."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)
