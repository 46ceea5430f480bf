"""Discs on the sphere as sets of nested HEALPix pixels, and joins that meet in them.

A disc is covered by descent: from the twelve faces down, pixels beyond it are dropped, pixels wholly inside
may be kept as they are, and those on its rim are divided. The descent runs on whole Arrow batches (as nested
column expressions it would be copied into every filter); nothing is shuffled before the join on the pixels found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.healpix import MAX_DEPTH, covered, pixel_width, with_healpix_index
from starloom.functions.sky import chord, unit_vector

#: Depth of the map that densities are read from: 12,288 pixels of 3.4 square degrees.
MAP_ORDER = 5
_XYZ = ("__qx", "__qy", "__qz")
_GROUP = ("__tile", "__p", "__d")
#: Discs that are covered at a time.
AT_ONCE = 4096
#: Points that a tile holds on the average, and the most points and discs that meet in one group.
TILE_POINTS, MOST_POINTS, MOST_DISCS = 1 << 15, 1 << 19, 1 << 18


def chord_squared(a: tuple[str, ...], b: tuple[str, ...]) -> Column:
    total = F.lit(0.0)
    for p, q in zip(a, b):
        total = total + (F.col(p) - F.col(q)) * (F.col(p) - F.col(q))
    return total


def with_vector(df: DataFrame, position: tuple[str, str], names: tuple[str, str, str] = _XYZ) -> DataFrame:
    """Rows with both coordinates, and their unit vector."""
    return df.dropna(subset=list(position)).withColumns(dict(zip(names, unit_vector(*position))))


def disc_cover(
    discs: DataFrame, stop: str = "__stop", reach: str = "__reach", whole: bool = False, xyz: tuple[str, str, str] = _XYZ
) -> DataFrame:
    """One row per disc and pixel of its cover: the columns of ``discs``, ``pixel``, ``pixel_order`` and ``whole``.

    ``discs`` has a unit vector in ``xyz``, the chord of its radius in ``reach`` and the depth to go down to in ``stop``.
    With ``whole`` a pixel all inside the disc is not divided and marked. A disc without a reach (null or NaN) has no rows.
    """
    names = discs.columns
    at = [names.index(c) for c in (*xyz, reach, stop)]

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(i, AT_ONCE)
                x, y, z, far, last = (part.column(k).to_numpy(zero_copy_only=False) for k in at)
                disc, pixel, order, inside = covered(np.stack((x, y, z), axis=1), far, last, whole)
                made = [pa.array(pixel), pa.array(order.astype(np.int32)), pa.array(inside)]
                taken = part.take(pa.array(disc))
                yield pa.RecordBatch.from_arrays([*taken.columns, *made], [*names, "pixel", "pixel_order", "whole"])

    usable = discs.where(f"`{reach}` >= 0 AND NOT isnan(`{reach}`)")
    schema = T.StructType([*discs.schema.fields, *(T.StructField(n, k) for n, k in (("pixel", T.LongType()), ("pixel_order", T.IntegerType()), ("whole", T.BooleanType())))])
    return usable.mapInArrow(cover, schema)


def depth_for(points: DataFrame, position: tuple[str, str], per_pixel: float = 4.0, densest: bool = False) -> int:
    """Depth at which a pixel holds about ``per_pixel`` points where there are any, or at most so many where they are ``densest``.

    Read from a map of counts, of which one row comes back.
    """
    counts = points.dropna(subset=list(position)).select(*position).transform(with_healpix_index(*position, MAP_ORDER, "__tile")).groupBy("__tile").count()
    row = counts.agg(F.avg("count").alias("mean"), F.max("count").alias("most")).first()
    value = row["most" if densest else "mean"] or 1.0
    return max(0, min(MAX_DEPTH, MAP_ORDER + round(math.log(max(value, 1.0) / per_pixel, 4))))


def width_chord(depth: int) -> float:
    """Chord of a pixel's width."""
    return chord(min(180.0, pixel_width(depth)))


def at_orders(points: DataFrame, orders: list[int], position: tuple[str, str]) -> DataFrame:
    """One copy of each point per order with its ``pixel_order`` and ``pixel``."""
    fine = max(orders, default=0)
    placed = points.transform(with_healpix_index(*position, fine, "__fine"))
    pixel = F.expr(f"shiftright(__fine, 2 * ({fine} - pixel_order))")
    copies = F.explode(F.array(*(F.lit(o) for o in orders))) if orders else F.explode(F.array().cast("array<int>"))
    return placed.withColumn("pixel_order", copies).withColumn("pixel", pixel).drop("__fine")


def orders_of(cover: DataFrame, only: str = "true") -> list[int]:
    """The orders that occur in a cover; 30 at most."""
    return sorted(r[0] for r in cover.where(only).select("pixel_order").distinct().collect())


def with_local_stop(discs: DataFrame, points: DataFrame, position: tuple[str, str], at: tuple[str, str], per_pixel: float = 4.0) -> DataFrame:
    """``__stop`` for each disc: the depth at which a pixel near its centre holds about ``per_pixel`` points.

    Read from the map of counts of ``points``, which has 12,288 rows at most and is broadcast.
    """
    tile = with_healpix_index(*position, MAP_ORDER, "__tile")
    counts = points.dropna(subset=list(position)).select(*position).transform(tile).groupBy("__tile").agg(F.count("*").alias("__near"))
    depth = F.lit(MAP_ORDER) + F.round(F.log2(F.coalesce("__near", F.lit(1)) / F.lit(per_pixel)) / 2).cast("int")
    stop = F.greatest(F.lit(0), F.least(F.lit(MAX_DEPTH), depth)).cast("int")
    placed = discs.transform(with_healpix_index(*at, MAP_ORDER, "__tile")).join(F.broadcast(counts), "__tile", "left")
    return placed.withColumn("__stop", stop).drop("__tile", "__near")


def order_for(radius_deg: Column, detail: int) -> Column:
    """Depth of pixels about ``2 ** detail`` times narrower than a radius, as :func:`disc_order` of the HEALPix functions."""
    finer = F.ceil(F.log2(F.try_divide(F.lit(pixel_width(0)), radius_deg))) + F.lit(detail)
    return F.greatest(F.lit(0), F.least(F.lit(MAX_DEPTH), F.coalesce(finer, F.lit(MAX_DEPTH)))).cast("int")


def reach_of(radius_deg: Column) -> Column:
    """Chord of a radius in degrees; null without one, for NaN and below zero."""
    known = (radius_deg >= 0) & ~F.isnan(radius_deg)
    return F.when(known, 2 * F.sin(F.radians(F.least(radius_deg, F.lit(180.0))) / 2))


def tile_order(radius_deg: Column, points: DataFrame, position: tuple[str, str]) -> Column:
    """Depth of tiles about twice as wide as a radius, or wider ones where they would hold few points."""
    return F.least(order_for(radius_deg, -1), F.lit(depth_for(points, position, TILE_POINTS)))


def meet_in_tiles(
    points: DataFrame,
    rows: DataFrame,
    cover: DataFrame,
    position: tuple[str, str],
    meet: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    xyz: tuple[str, str, str] = _XYZ,
) -> DataFrame:
    """``meet`` on the points of each tile and the discs whose ``cover`` holds it, as Arrow tables.

    A point lies in one tile of each order of the cover, so a point and a disc meet once at most. The sides of a
    crowded tile are parted, and each part of the points meets each part of the discs in a group of its own;
    ``meet`` gives results that add up. ``rows`` has the positions that crowded tiles are told from: the rows
    ``points`` was made of, copies included, so that no shuffle is needed for them.
    """
    spark, tile = points.sparkSession, F.expr("shiftleft(4L, 2 * pixel_order) + pixel").alias("__tile")  # one number for order and pixel

    def crowded(placed: DataFrame, most: int, parts: str) -> DataFrame:
        counted = placed.groupBy(tile).agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias(parts))
        return F.broadcast(counted.where(f"{parts} > 1"))

    # told by the position, as a filter on the pixel is copied down to the scan with the whole formula
    on_sphere = F.col(position[1]).between(-90.0, 90.0) & (F.abs(position[0]) < F.lit(math.inf))
    orders = orders_of(cover)
    sides = crowded(at_orders(rows.select(*position).where(on_sphere), orders, position), MOST_POINTS, "__ps"), crowded(cover.select("pixel_order", "pixel"), MOST_DISCS, "__ds")

    def dealt(df: DataFrame, own: str, by: tuple[str, ...]) -> DataFrame:
        columns = [c for c in df.columns if c not in ("pixel_order", "pixel", "whole")]
        parts = df.select(*columns, tile).join(sides[0], "__tile", "left").join(sides[1], "__tile", "left").fillna(1, ["__ps", "__ds"])
        mine, other = ("__p", "__d") if own == "__ps" else ("__d", "__p")
        every = F.explode(F.sequence(F.lit(0), F.col("__ds" if own == "__ps" else "__ps") - 1))
        parts = parts.withColumn(mine, F.pmod(F.xxhash64(*by), own).cast("int")).withColumn(other, every)
        # a given number is not coalesced: the work is in the boxes, not in the bytes
        return parts.select(*columns, *_GROUP).repartition(tasks, *_GROUP)

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    placed = at_orders(points.where(on_sphere), orders, position)
    left, right = dealt(placed, "__ps", position), dealt(cover, "__ds", xyz)
    return left.groupBy(*_GROUP).cogroup(right.groupBy(*_GROUP)).applyInArrow(meet, schema)


def columns_of(table: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    return np.stack([table.column(n).to_numpy() for n in names], axis=1)
