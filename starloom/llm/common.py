"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import stage

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE = 256
#: Masks that are broadcast at most, some 40 MB; they hold 67 million row numbers where these are dense.
MOST_MASKS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def utf8(values: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in values.cast(pa.binary()).to_pylist()]


def texts(values: pa.Array) -> list[str]:
    """Texts; null counts as empty."""
    return [x or "" for x in values.to_pylist()]


def slices(batches: Iterator[pa.Array | pa.RecordBatch]) -> Iterator[pa.Array | pa.RecordBatch]:
    """All batches in short slices, so that few rows, and few results, are in a worker's memory at once."""
    for batch in batches:
        for i in range(0, len(batch), SLICE):
            yield batch.slice(i, SLICE)


def short(batch: pa.Array | pa.RecordBatch, most: int) -> Iterator[pa.Array | pa.RecordBatch]:
    """Slices of at most ``SLICE`` rows and, but for single longer texts, ``most`` bytes of the texts or of the last column."""
    values = batch.column(batch.num_columns - 1) if isinstance(batch, pa.RecordBatch) else batch
    sizes = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(sizes):
        till = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + SLICE]), most, "right")))
        yield batch.slice(at, till - at)
        at = till


def among(rows: DataFrame, keys: DataFrame, column: str, most: int = MOST_MASKS) -> DataFrame:
    """The ``rows`` whose whole number in ``column`` is also in that column of ``keys``; null is in none.

    The numbers wanted are sent to the rows as masks, one for 64 neighbouring numbers, so wide rows are not shuffled
    to find those wanted. More than ``most`` masks are not broadcast: then rows and keys meet in a shuffle.
    """
    number = F.col(column)
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63L AS int))")
    masks = stage(keys.groupBy(F.shiftright(number, 6).alias("__block")).agg(F.bit_or(bit).alias("__mask")), "masks")
    if masks.count() > most:
        return rows.join(keys.select(column), column, "left_semi")
    wanted = (F.shiftright(number, 6) == F.col("__block")) & F.expr(f"getbit(__mask, cast(`{column}` & 63L AS int)) = 1")
    return rows.join(F.broadcast(masks), wanted, "left_semi")


def hex64(value: Column) -> Column:
    """A 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def signed(value: int) -> int:
    """An unsigned 64-bit constant as the long with the same bits."""
    return value - (1 << 64) if value >> 63 else value
