"""Sky quantities as native column expressions. Angles are in degrees."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the catalogue pipeline.
EPOCH_STARS = 2016.0
EPOCH_OBJECTS = 2000.0
MAS_TO_DEG = 1.0 / 3.6e6
ARCSEC = 1.0 / 3600.0
KM_PER_S = 4.74
RUWE_LIMIT = 1.4
PARALLAX_RELATIVE_ERROR = 0.2


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_vector(ra: Column | str, dec: Column | str) -> tuple[Column, Column, Column]:
    """Cartesian direction (x, y, z) of a position."""
    lon, lat = F.radians(as_column(ra)), F.radians(as_column(dec))
    return F.cos(lon) * F.cos(lat), F.cos(lat) * F.sin(lon), F.sin(lat)


def with_unit_vectors(
    ra: str, dec: str, names: tuple[str, str, str] = ("x_unit", "y_unit", "z_unit")
) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns(dict(zip(names, unit_vector(ra, dec))))


def flat_separation(ra_l: Column | str, dec_l: Column | str, ra_r: Column | str, dec_r: Column | str) -> Column:
    """Flat-sky distance with the cosine of the left declination; no wrap at 0/360."""
    ra_l, dec_l, ra_r, dec_r = map(as_column, (ra_l, dec_l, ra_r, dec_r))
    along_ra = (ra_l - ra_r) * F.cos(F.radians(dec_l))
    return F.sqrt(F.pow(along_ra, 2) + F.pow(dec_l - dec_r, 2))


def great_circle_separation(
    ra_l: Column | str, dec_l: Column | str, ra_r: Column | str, dec_r: Column | str
) -> Column:
    """Exact separation by the haversine formula; right at the poles and across 0/360."""
    ra_l, dec_l, ra_r, dec_r = (F.radians(as_column(c)) for c in (ra_l, dec_l, ra_r, dec_r))
    half = F.pow(F.sin((dec_l - dec_r) / 2), 2) + F.cos(dec_l) * F.cos(dec_r) * F.pow(F.sin((ra_l - ra_r) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(half, F.lit(1.0)))))


def with_separation(
    ra_l: str, dec_l: str, ra_r: str, dec_r: str, exact: bool = False, out: str = "threshold_angular_d"
) -> Callable[[DataFrame], DataFrame]:
    formula = great_circle_separation if exact else flat_separation
    return lambda df: df.withColumn(out, formula(ra_l, dec_l, ra_r, dec_r))


def distance_parsec(parallax: Column | str, reliable: Column | str) -> Column:
    """1000/parallax (mas) where the parallax is reliable, else 0.0."""
    return F.when(as_column(reliable), F.try_divide(F.lit(1000.0), as_column(parallax))).otherwise(F.lit(0.0))


def with_distance_parsec(parallax: str, reliable: str, out: str = "distance_pc") -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn(out, distance_parsec(parallax, reliable))


def absolute_magnitude(magnitude: Column | str, distance: Column | str, unreliable_as_null: bool = False) -> Column:
    """m - 5·log10(d) + 5.

    A distance of zero stands for "not reliable" and gives +Infinity, or null on request.
    """
    m, d = as_column(magnitude).cast("double"), as_column(distance)
    at_zero = F.lit(None).cast("double") if unreliable_as_null else F.lit(float("inf"))
    return F.when(m.isNull() | d.isNull(), None).when(d == 0, at_zero).otherwise(m - 5 * F.log10(d) + 5)


def with_absolute_magnitudes(
    j: str, h: str, ks: str, distance: str, unreliable_as_null: bool = False
) -> Callable[[DataFrame], DataFrame]:
    bands = {"abs_mag_j": j, "abs_mag_h": h, "abs_mag_ks": ks}
    return lambda df: df.withColumns(
        {out: absolute_magnitude(band, distance, unreliable_as_null) for out, band in bands.items()}
    )


def motion_degrees(
    motion_mas: Column | str, epoch_from: float = EPOCH_OBJECTS, epoch_to: float = EPOCH_STARS
) -> Column:
    """Arc travelled between the epochs at ``motion_mas`` per year; null motion counts as none."""
    return F.coalesce(as_column(motion_mas), F.lit(0.0)) * F.lit((epoch_to - epoch_from) * MAS_TO_DEG)


def propagate(
    ra: Column | str,
    dec: Column | str,
    pmra: Column | str,
    pmdec: Column | str,
    epoch_from: float = EPOCH_OBJECTS,
    epoch_to: float = EPOCH_STARS,
) -> tuple[Column, Column]:
    """Position moved from one epoch to another by a proper motion in mas/yr."""
    ra, dec = as_column(ra), as_column(dec)
    east = motion_degrees(pmra, epoch_from, epoch_to)
    north = motion_degrees(pmdec, epoch_from, epoch_to)
    return ra + F.try_divide(east, F.cos(F.radians(dec))), dec + north


def with_propagated_position(
    ra: str, dec: str, pmra: str, pmdec: str, names: tuple[str, str] = ("ra_prop", "dec_prop"), **epochs: float
) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns(dict(zip(names, propagate(ra, dec, pmra, pmdec, **epochs))))


def tangential_velocity(
    distance: Column | str, pmra: Column | str, pmdec: Column | str, corrected: bool = False
) -> Column:
    """Default: 4.74·d·√(pmra²) + pmdec², the form existing tables were made with.

    ``corrected`` gives the textbook 4.74·(d/1000)·√(pmra² + pmdec²) in km/s.
    """
    d, a, b = map(as_column, (distance, pmra, pmdec))
    if corrected:
        return F.lit(KM_PER_S) * (d / 1000.0) * F.sqrt(F.pow(a, 2) + F.pow(b, 2))
    return F.lit(KM_PER_S) * d * F.sqrt(F.pow(a, 2)) + F.pow(b, 2)


def reliable_astrometry(ruwe: Column | str) -> Column:
    return as_column(ruwe) < F.lit(RUWE_LIMIT)


def reliable_parallax(parallax: Column | str, parallax_error: Column | str) -> Column:
    """parallax_error/parallax below 0.2 and parallax positive; safe at parallax zero."""
    plx = as_column(parallax)
    ratio = F.try_divide(as_column(parallax_error), plx)
    return (plx > 0) & (ratio < F.lit(PARALLAX_RELATIVE_ERROR))


_SEXAGESIMAL = r"^\s*([+-]?)\s*(\d+)\s*[hd:°\s]\s*(\d+)\s*[m:'\s]\s*(\d+(?:\.\d*)?)\s*[s\"]?\s*$"


def sexagesimal_to_degrees(text: Column | str, hours: bool | None = None) -> Column:
    """Degrees from text such as ``02h07m10.40s``, ``+23d27m44.7s`` or ``02:07:10.4``.

    ``hours`` says whether the first field is an hour angle (×15); by default it is when
    the text contains an ``h``. Text in any other form gives null.
    """
    text = as_column(text)

    def part(i: int) -> Column:
        return F.regexp_extract(text, _SEXAGESIMAL, i)

    # "" (no match) must not reach the cast under ANSI rules
    value = part(2).try_cast("double") + part(3).try_cast("double") / 60.0 + part(4).try_cast("double") / 3600.0
    if hours is None:
        scale = F.when(text.contains("h"), 15.0).otherwise(1.0)
    else:
        scale = F.lit(15.0 if hours else 1.0)
    return F.when(part(1) == "-", -value).otherwise(value) * scale


def chord(radius_deg: float) -> float:
    """Straight-line distance on the unit sphere that spans ``radius_deg``."""
    return 2.0 * math.sin(math.radians(min(radius_deg, 180.0)) / 2.0)
