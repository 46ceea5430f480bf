"""Cones, counts, pairs and nearest counterparts on the sphere.

Positions are compared by the straight chord between unit vectors, which is exact at the
poles and across 0/360. Joins meet in cubic cells of the unit cube: one side has exactly
one cell per row, the other is copied into every cell within the search radius, so each
pair is met once and no nested loop is needed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.healpix import disc_ranges, pixel_width
from starloom.functions.keys import NO_MATCH, clip
from starloom.functions.pointtree import PointTree
from starloom.functions.sky import (
    ARCSEC,
    chord,
    flat_separation,
    great_circle_separation,
    motion_degrees,
    propagate,
    unit_vector,
)
from starloom.operators.discs import at_orders, chord_squared, columns_of, depth_for, disc_cover, meet_in_tiles, order_for, orders_of, reach_of, tile_order, with_vector
from starloom.operators.ranking import nearest_by
from starloom.session import stage

_CELL = ("__cx", "__cy", "__cz")


def valid_coordinates(ra: str = "ra", dec: str = "dec") -> Callable[[DataFrame], DataFrame]:
    """Rows whose two coordinates are both present (neither null nor NaN)."""
    return lambda df: df.dropna(subset=[ra, dec])


def _chord_squared(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    dx, dy, dz = (p - q for p, q in zip(a, b))
    return dx * dx + dy * dy + dz * dz


def in_cone(ra: str, dec: str, ra_center: float, dec_center: float, radius_deg: float) -> Column:
    """Whether a position lies within ``radius_deg`` of a centre.

    The declination range is given as a plain comparison as well, so that it reaches the
    Parquet statistics.
    """
    lon, lat = math.radians(ra_center), math.radians(dec_center)
    center = tuple(
        F.lit(v) for v in (math.cos(lon) * math.cos(lat), math.cos(lat) * math.sin(lon), math.sin(lat))
    )
    near = _chord_squared(unit_vector(ra, dec), center) <= F.lit(chord(radius_deg) ** 2)
    margin = radius_deg + 1e-9
    return F.col(dec).between(dec_center - margin, dec_center + margin) & near


def in_ranges(column: str, ranges: Sequence[tuple[int, int]]) -> Column:
    """Whether a pixel lies in one of the ranges; plain comparisons, which reach partitions and Parquet statistics."""
    wanted = F.lit(False)
    for low, high in ranges:
        wanted = wanted | (F.col(column) == low if low == high else F.col(column).between(low, high))
    return wanted


def cone_search(
    ra_center: float,
    dec_center: float,
    radius_deg: float,
    ra: str = "ra",
    dec: str = "dec",
    tiles: tuple[str, Sequence[int]] | None = None,
    pixels: Sequence[tuple[str, int]] = (),
) -> Callable[[DataFrame], DataFrame]:
    """Rows within ``radius_deg`` of a centre.

    ``pixels`` names columns that hold the nested pixel of a row and their orders; the cone's index ranges of that order
    become comparisons, so that partitions and row groups without such pixels are not opened. ``tiles`` does the
    same with a list of tiles (from :func:`covering_tiles`). Neither runs a job.
    """
    near = in_cone(ra, dec, ra_center, dec_center, radius_deg)
    if tiles is not None:
        near = F.col(tiles[0]).isin(*tiles[1]) & near
    for column, order in pixels:
        near = in_ranges(column, disc_ranges(ra_center, dec_center, radius_deg, order)) & near
    return lambda df: df.filter(near)


def covering_tiles(ra_center: float, dec_center: float, radius_deg: float, order: int = 2) -> list[int]:
    """Pixels of ``order`` that can hold a position within ``radius_deg`` of a centre; few of them miss the cone."""
    return [t for low, high in disc_ranges(ra_center, dec_center, radius_deg, order) for t in range(low, high + 1)]


def _cell_of(xyz: tuple[str, str, str], size: float) -> dict[str, Column]:
    return {c: F.floor(F.col(k) / F.lit(size)) for c, k in zip(_CELL, xyz)}


def _copy_into_cells(df: DataFrame, xyz: tuple[str, str, str], reach: float, size: float) -> DataFrame:
    """One copy of each row per cell on the sphere that its box of half-width ``reach`` touches."""
    nearest, farthest = F.lit(0.0), F.lit(0.0)
    for cell, k in zip(_CELL, xyz):
        low, high = (F.floor((F.col(k) + F.lit(step)) / F.lit(size)) for step in (-reach, reach))
        df = df.withColumn(cell, F.explode(F.sequence(low, high)))
        near, far = _span(F.col(cell) * F.lit(size), size)
        nearest, farthest = nearest + near, farthest + far
    slack = F.lit(1e-9)
    return df.filter((nearest <= F.lit(1.0) + slack) & (farthest >= F.lit(1.0) - slack))


def _guarded(df: DataFrame, source: DataFrame, copies: float) -> DataFrame:
    """``df``, made of about ``copies`` rows per row of ``source``, ready to be joined.

    Catalyst broadcasts by an estimate that does not see how far ``explode`` multiplies
    rows. Where the multiplied estimate passes the broadcast threshold, a merge hint rules
    the broadcast out; below it the choice is left to Spark.
    """
    estimate = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df.hint("merge") if estimate * copies > threshold else df


def _copies(cell_factor: float) -> float:
    """Expected cells per row for a reach of one and cells of ``cell_factor``, on a surface."""
    return 1.5 * (1.0 + 2.0 / cell_factor) ** 2


def _span(offset: Column, size: float) -> tuple[Column, Column]:
    """Least and greatest square of a number in [offset, offset + size]."""
    end = offset + F.lit(size)
    return F.pow(F.greatest(offset, -end, F.lit(0.0)), 2), F.pow(F.greatest(F.abs(offset), F.abs(end)), 2)


def pairs_within(
    left: DataFrame,
    right: DataFrame,
    radius_deg: float = 1.0,
    left_position: tuple[str, str] = ("ra", "dec"),
    right_position: tuple[str, str] = ("ra_r", "dec_r"),
    cell_factor: float = 1.0,
) -> DataFrame:
    """Every (left, right) pair at most ``radius_deg`` apart, with the columns of both.

    The output holds every pair, so it grows with the square of the density; use
    :func:`nearest_within` where a count and the nearest will do.

    ``right`` is the side copied into cells: pass the smaller table there. Column names of
    the two sides must differ. Larger ``cell_factor`` means fewer copies and more candidates
    per cell: 1 suits degree-wide searches, 16 and more arcsecond ones.
    """
    reach = chord(radius_deg) * (1.0 + 1e-12)
    size = reach * cell_factor
    lx, rx = ("__lx", "__ly", "__lz"), ("__rx", "__ry", "__rz")
    l = left.dropna(subset=list(left_position)).withColumns(dict(zip(lx, unit_vector(*left_position))))
    r = right.dropna(subset=list(right_position)).withColumns(dict(zip(rx, unit_vector(*right_position))))
    l = l.withColumns(_cell_of(lx, size))
    r = _guarded(_copy_into_cells(r, rx, reach, size), r, _copies(cell_factor))
    distance = _chord_squared(tuple(F.col(c) for c in lx), tuple(F.col(c) for c in rx))
    return (
        l.join(r, list(_CELL), "inner")
        .filter(distance <= F.lit(chord(radius_deg) ** 2))
        .select(*left.columns, *right.columns)
    )


def nearest_within(
    stars: DataFrame,
    objects: DataFrame,
    radius_deg: float = 1.0,
    label: str = "main_id",
    out: tuple[str, str] = ("n_objects", "nearest"),
    reports: list[tuple[float, int]] | None = None,
) -> DataFrame:
    """``stars`` with the number of ``objects`` within ``radius_deg`` and the label of the nearest one.

    One row per star row, so the output grows with the stars however dense the sky is
    (:func:`pairs_within` gives every pair). Stars lie in one tile each, and objects are copied into the tiles
    they reach; there they lie in nested boxes. The count adds up the boxes wholly within the radius of the star and opens those
    on the rim. The nearest is looked for in rings: the first radius is the width of pixels with few objects where
    these are densest, the next four times that. A star leaves when it has found one, and only the others wait for the next ring, which
    ``reports`` counts as (radius, stars waiting). Equal distances go to the smaller label. Stars without a
    position or an object in reach have 0 and null.
    """
    spots = objects.dropna(subset=["ra", "dec"]).groupBy("ra", "dec").agg(F.min(label).alias("__label"), F.count("*").alias("__n"))
    spots = stage(spots.select(F.col("ra").alias("ra_r"), F.col("dec").alias("dec_r"), "__label", "__n"), "nearest-objects")
    places = stars.select(F.col("ra").cast("double"), F.col("dec").cast("double")).dropna().distinct()
    reach = min(radius_deg, pixel_width(depth_for(spots, ("ra_r", "dec_r"), densest=True)))
    rings = [reach]
    while rings[-1] < radius_deg:
        rings.append(min(radius_deg, 4 * rings[-1]))
    met = _nearest_in_tiles(stars, places, spots, radius_deg, rings)
    if reports is not None:
        met = stage(met, "nearest-found")
        left, in_ring = places.count(), dict(met.groupBy("ra", "dec").agg(F.min("__ring").alias("__ring")).groupBy("__ring").count().collect())
        for i, wider in enumerate(rings[1:]):
            left -= in_ring.get(i, 0)
            reports.append((wider, left))
            if not left:
                break
    separation = great_circle_separation("ra", "dec", "ra_r", "dec_r")
    known = met.groupBy("ra", "dec").agg(
        F.sum("__n").alias(out[0]), F.min_by("__label", F.struct(F.round(separation, 9), "__label")).alias(out[1])
    )
    joined = stars.join(known, ["ra", "dec"], "left")
    return joined.select(*stars.columns, F.coalesce(out[0], F.lit(0).cast("long")).alias(out[0]), out[1])


_PX, _QX = ("__px", "__py", "__pz"), ("__qx", "__qy", "__qz")


def _nearest_in_tiles(stars: DataFrame, places: DataFrame, spots: DataFrame, radius_deg: float, rings: list[float]) -> DataFrame:
    """Per place and group with spots within a radius: the sum of ``__n`` in its first row, ring and nearest spots in one row each."""
    limit, chords = chord(radius_deg) ** 2, [chord(r) for r in rings]
    discs = with_vector(spots, ("ra_r", "dec_r"), _QX).withColumn("__reach", F.lit(chord(radius_deg)))
    discs = discs.withColumn("__stop", tile_order(F.lit(float(radius_deg)), stars, ("ra", "dec")))
    cover = stage(disc_cover(discs).drop("__reach", "__stop"), "disc-cover")

    def meet(points: pa.Table, near: pa.Table) -> pa.Table:
        place = row = ring = n = np.zeros(0, np.int64)
        if points.num_rows and near.num_rows:
            at = columns_of(points, _PX)
            tree = PointTree(columns_of(near, _QX), near.column("__n").to_numpy())
            sums = tree.count(at, np.full(len(at), chords[-1]), np.full(len(at), limit))
            has = np.flatnonzero(sums)
            place, row, ring = tree.nearest(at[has], chords, limit)
            order = np.argsort(place, kind="stable")
            place, row, ring = has[place[order]], row[order], ring[order]
            n = np.where(np.diff(place, prepend=-1) > 0, sums[place], 0)
        own, others = points.select(["ra", "dec"]).take(pa.array(place)), near.select(["ra_r", "dec_r", "__label"]).take(pa.array(row))
        made = {"__n": pa.array(n), "__ring": pa.array(ring.astype(np.int32))}
        return pa.table({**{t.column_names[i]: c for t in (own, others) for i, c in enumerate(t.columns)}, **made})

    types = ", ".join(f"{c} {cover.schema[c].dataType.simpleString()}" for c in ("ra_r", "dec_r", "__label"))
    schema = f"ra double, dec double, {types}, __n long, __ring int"
    return meet_in_tiles(with_vector(places, ("ra", "dec"), _PX), stars, cover, ("ra", "dec"), meet, schema)


def count_in_cones(
    points: DataFrame,
    centers: DataFrame,
    radius_deg: float | str,
    position: tuple[str, str] = ("ra", "dec"),
    center_position: tuple[str, str] = ("ra", "dec"),
    per_pixel: float = 4.0,
) -> DataFrame:
    """``centers`` with ``n_obs``, the number of points within ``radius_deg`` of each, a number or a column of degrees.

    The points are summed up per position. Each lies in one tile of the sphere, about twice as wide as the radius or wider, and a
    cone meets those of the tiles it touches: there they lie in nested boxes of down to ``per_pixel`` points, of which a
    cone takes the sums of those wholly inside and opens those on its rim. So a cone looks at about as many points as its
    rim has boxes, which grow with the square root of the density, and what is shuffled grows with points and cones alone.
    Centres without points, position or radius get 0.
    """
    radius = F.col(radius_deg) if isinstance(radius_deg, str) else F.lit(float(radius_deg))
    heads = centers.select(*(F.col(c).cast("double").alias(n) for c, n in zip(center_position, ("__qra", "__qdec"))), radius.cast("double").alias("__radius"))
    heads = with_vector(heads.distinct(), ("__qra", "__qdec"), _QX).withColumn("__reach", reach_of(F.col("__radius")))
    heads = heads.where("__reach IS NOT NULL").withColumn("__stop", tile_order(F.col("__radius"), points, position))
    cover = stage(disc_cover(heads).withColumn("__limit", F.pow("__reach", 2)).drop("__stop"), "disc-cover")
    at_point = {"__ra": F.col(position[0]), "__dec": F.col(position[1])}
    rows = points.dropna(subset=list(position)).select(*(c.alias(n) for n, c in at_point.items()))
    spots = with_vector(rows.groupBy(*at_point).agg(F.count("*").alias("__n")), ("__ra", "__dec"), _PX)
    key = ["__qra", "__qdec", "__radius"]

    def meet(near: pa.Table, cones: pa.Table) -> pa.Table:
        n = np.zeros(cones.num_rows, np.int64)
        if near.num_rows and cones.num_rows:
            tree = PointTree(columns_of(near, _PX), near.column("__n").to_numpy(), per_pixel)
            n = tree.count(columns_of(cones, _QX), cones.column("__reach").to_numpy(), cones.column("__limit").to_numpy())
        return cones.select(key).append_column("__n", pa.array(n)).filter(pa.array(n > 0))

    met = meet_in_tiles(spots, rows, cover, ("__ra", "__dec"), meet, "__qra double, __qdec double, __radius double, __n long")
    totals = met.groupBy(*key).agg(F.sum("__n").alias("n_obs"))
    at = {"__qra": F.col(center_position[0]).cast("double"), "__qdec": F.col(center_position[1]).cast("double"), "__radius": radius.cast("double")}
    joined = centers.withColumns(at).join(totals, key, "left").drop(*key)
    return joined.withColumn("n_obs", F.coalesce("n_obs", F.lit(0).cast("long")))


def pairs_in_cones(
    points: DataFrame,
    centers: DataFrame,
    radius: str = "radius_deg",
    position: tuple[str, str] = ("ra", "dec"),
    center_position: tuple[str, str] = ("ra_r", "dec_r"),
) -> DataFrame:
    """Every (point, centre) pair within the centre's own ``radius`` in degrees, with the columns of both.

    Radii fall into classes by powers of two. Each class covers its cones with pixels at most as wide as the
    radius, some twenty a cone, and a point has one pixel per class that occurs, so a narrow cone does not pay for a wide
    one. Column names must differ. Centres without position or radius meet nothing. The output holds every
    pair, so it grows with the area of the cones and the density.
    """
    discs = with_vector(centers, center_position, _QX)
    discs = discs.withColumn("__reach", reach_of(F.col(radius).cast("double"))).where("__reach IS NOT NULL").withColumn("__stop", order_for(F.col(radius), 0))
    orders = orders_of(discs.select(F.col("__stop").alias("pixel_order")))  # the cover ends in these, and need not be kept
    placed = at_orders(with_vector(points, position, _PX), orders, position)
    met = placed.join(disc_cover(discs), ["pixel_order", "pixel"]).where(chord_squared(_PX, _QX) <= F.pow("__reach", 2))
    return met.select(*points.columns, *centers.columns)


# Fixed values of the density search.
DENSITY_TARGET_ROWS = 250000
DENSITY_RADIUS_MIN = 0.1
DENSITY_RADIUS_MAX = 2.0
DENSITY_TEST_RADIUS = 0.1


def density_radius(
    counted: DataFrame,
    on_empty: str = "fail",
    target_rows: float = DENSITY_TARGET_ROWS,
    test_radius: float = DENSITY_TEST_RADIUS,
) -> DataFrame:
    """Add ``radius_deg``, the radius expected to hold ``target_rows`` sources around each centre.

    The density comes from ``n_obs`` counted within ``test_radius`` degrees. A centre without sources has no
    density: that stops the job, gives null with ``on_empty="null"`` or the largest radius with ``on_empty="largest"``.
    """
    area = math.pi * test_radius**2
    density = F.col("n_obs") / F.lit(area)
    radius = F.sqrt(F.lit(float(target_rows)) / density / F.lit(math.pi))
    empties = {
        "fail": F.raise_error(F.lit("no sources around a centre")).cast("double"),
        "null": F.lit(None).cast("double"),
        "largest": F.lit(DENSITY_RADIUS_MAX),
    }
    return counted.withColumn(
        "radius_deg",
        F.when(F.col("n_obs") == 0, empties[on_empty]).otherwise(clip(radius, DENSITY_RADIUS_MIN, DENSITY_RADIUS_MAX)),
    )


def counterparts(
    stars: DataFrame,
    objects: DataFrame,
    tolerance_deg: float = ARCSEC,
    mode: str = "pixel",
    pixel: str = "healpix_index",
    cell_factor: float = 4.0,
    distinct_positions: bool = True,
    key: str = "source_id",
) -> DataFrame:
    """Every (star, object) match within ``tolerance_deg``: ``key``, ``ra_r``, ``dec_r``,
    ``ra_prop``, ``dec_prop``, ``bk_simbad``, ``threshold_angular_d``.

    The object position is first moved by the star's proper motion; a null motion counts as
    none, a NaN motion gives a NaN distance and so matches nothing. Of objects at one and the
    same position only the smallest key counts, which is all that the nearest counterpart
    needs; ``distinct_positions=False`` keeps every object.

    ``mode="pixel"`` keeps the historic meaning: flat-sky distance, and only objects of the
    star's own pixel. ``mode="exact"`` uses the great circle and knows no pixel edges.

    How it scales: only ``key``, position, motion and pixel of a star take part. A star is
    moved *back* by its motion and lies in exactly one cell; the objects are copied into the
    few cells they can reach. The reach of four tolerances covers every possible counterpart
    of a star unless it is within arcseconds of a pole or its motion is absurd. Those few
    stars are recognised row by row and meet the objects by strips of declination instead:
    the moved declination must come within the tolerance of the star's; where there are none, which one look at the
    stars tells, their branch is left out of the plan. All joins are inner, so
    AQE can split a crowded cell on either side. A smaller ``cell_factor`` means more copies of
    the objects and fewer candidates per star: 1 suits crowded fields.
    """
    if mode not in ("pixel", "exact"):
        raise ValueError(f"mode must be pixel or exact, got {mode}")
    reach = chord(4.0 * tolerance_deg)
    size = reach * cell_factor
    tol = math.radians(tolerance_deg)

    spots = objects.dropna(subset=["ra", "dec"]).select(
        F.col("ra").alias("ra_r"), F.col("dec").alias("dec_r"), F.col(pixel).alias("__pixel_r"), "bk_simbad"
    )
    if distinct_positions:
        spots = spots.groupBy("ra_r", "dec_r", "__pixel_r").agg(F.min("bk_simbad").alias("bk_simbad"))

    own_pixel = [F.col(pixel)] if mode == "pixel" else []
    slim = stars.select(key, "ra", "dec", "pmra", "pmdec", *(c.alias("__pixel") for c in own_pixel))
    still = [F.coalesce(F.isnan(m), F.lit(False)) for m in ("pmra", "pmdec")]
    slim = slim.dropna(subset=["ra", "dec"]).where(~(still[0] | still[1]))
    east, north = motion_degrees("pmra"), motion_degrees("pmdec")
    dec_back = F.col("dec") - north
    cos_star, cos_back = F.cos(F.radians("dec")), F.cos(F.radians(dec_back))
    ra_back = F.col("ra") - F.try_divide(east, cos_back)
    # Bound on the distance from the moved-back star to any counterpart, in tolerances.
    bound = (
        F.lit(math.pi / 2) * F.try_divide(cos_back + tol, cos_star - tol)
        + F.try_divide(F.abs(F.radians(east)), cos_back)
        + 1.0
    )
    calm = F.coalesce((cos_star > 2 * tol) & (cos_back > 2 * tol) & (bound <= 3.9), F.lit(False))

    rx, lx = ("__rx", "__ry", "__rz"), ("__lx", "__ly", "__lz")
    near = _copy_into_cells(spots.withColumns(dict(zip(rx, unit_vector("ra_r", "dec_r")))), rx, reach, size).drop(*rx)
    near = _guarded(near, spots, _copies(cell_factor))
    placed = slim.where(calm).withColumns(dict(zip(lx, unit_vector(ra_back, dec_back)))).withColumns(_cell_of(lx, size))
    by_cell = placed.join(near, list(_CELL))

    # an angle and its mirror at the pole have the same sine; the flat distance knows no mirror
    width = 4.0 * tolerance_deg
    centres = [F.col("dec") - north]
    if mode == "exact":
        centres = [F.pmod(c + 180.0, F.lit(360.0)) - 180.0 for c in (F.col("dec") - north, 180.0 - F.col("dec") - north)]
    slack = F.lit(tolerance_deg * (1 + 1e-9) + 1e-9) + F.abs(north) * 1e-12
    # where the motion is too large to tell strips apart, all of them
    low, high = (F.greatest(F.lit(-91.0), F.least(F.lit(91.0), F.col("__centre") + w)) for w in (-slack, slack))
    strips = F.sequence(F.floor(low / width), F.floor(high / width))
    columns = (key, "ra", "dec", "pmra", "pmdec", "ra_r", "dec_r", "bk_simbad", "__pixel_r", *(["__pixel"] if own_pixel else []))
    met = by_cell.select(*columns)
    odd = slim.where(~calm)
    if not odd.isEmpty():
        odd = odd.withColumn("__centre", F.explode(F.array(*centres))).withColumn("__strip", F.explode(strips))
        odd = odd.drop("__centre").distinct()
        by_strip = odd.join(spots.withColumn("__strip", F.floor(F.col("dec_r") / width)), "__strip")
        met = met.unionByName(by_strip.select(*columns))
    ra_prop, dec_prop = propagate("ra_r", "dec_r", "pmra", "pmdec")
    formula = flat_separation if mode == "pixel" else great_circle_separation
    separation = formula("ra", "dec", ra_prop, dec_prop)
    close = separation <= F.lit(tolerance_deg)
    if mode == "pixel":
        close = close & (F.col("__pixel") == F.col("__pixel_r"))
    return met.where(close).select(
        key,
        "ra_r",
        "dec_r",
        ra_prop.alias("ra_prop"),
        dec_prop.alias("dec_prop"),
        "bk_simbad",
        separation.alias("threshold_angular_d"),
    )


_MATCHED = ("ra_r", "dec_r", "ra_prop", "dec_prop", "bk_simbad", "threshold_angular_d")


def attach_counterparts(stars: DataFrame, objects: DataFrame, *args: object, key: str = "source_id", **options: object) -> DataFrame:
    """Left join of stars to their :func:`counterparts`, whose arguments it takes.

    ``key`` must tell the stars apart. A star with several counterparts has several rows, one
    without any has one row with nulls.
    """
    return stars.join(counterparts(stars, objects, *args, key=key, **options), key, "left").select(*stars.columns, *_MATCHED)


def nearest_match(matches: DataFrame, key: str = "source_id") -> DataFrame:
    """One row per matched star: its nearest counterpart, ties to the smaller business key.

    Tasks reduce the matches before they are shuffled.
    """
    order = F.struct("threshold_angular_d", F.col("bk_simbad").isNull(), "bk_simbad")
    best = matches.groupBy(key).agg(F.min_by(F.struct(*_MATCHED), order).alias("m"))
    return best.select(key, "m.*")


def attach_nearest(stars: DataFrame, objects: DataFrame, *args: object, key: str = "source_id", **options: object) -> DataFrame:
    """Stars with their nearest counterpart or ``"-1"`` in ``bk_simbad``, exactly one row per star.

    The wide rows are shuffled on ``key`` alone, to meet one narrow row per matched star.
    """
    best = nearest_match(counterparts(stars, objects, *args, key=key, **options), key)
    joined = stars.join(best, key, "left").select(*stars.columns, *_MATCHED)
    return joined.withColumn("bk_simbad", F.coalesce("bk_simbad", F.lit(NO_MATCH)))


def nearest_counterpart(matched: DataFrame, key: str = "source_id") -> DataFrame:
    """One row per star: the nearest counterpart, or ``"-1"`` in ``bk_simbad``."""
    best = nearest_by(matched, key, "threshold_angular_d", "bk_simbad")
    return best.withColumn("bk_simbad", F.coalesce("bk_simbad", F.lit(NO_MATCH)))
