"""Nested HEALPix index (Górski et al. 2005) as plain column arithmetic.

The expression is kept small, because Catalyst copies it into every filter that it pushes
below the projection: each intermediate value is referred to only a few times.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DEPTH = 6  # nside 64
MAX_DEPTH = 29

_CHUNK = 6
# Entry i holds the bits of i moved to the even positions.
_SPREAD = [sum(((i >> b) & 1) << (2 * b) for b in range(_CHUNK)) for i in range(1 << _CHUNK)]
_SPREAD_SQL = f"array({', '.join(f'{v}L' for v in _SPREAD)})"


def _spread_bits(value: str, depth: int) -> str:
    """SQL for the bits of ``value`` at the even positions, looked up six at a time."""
    if depth <= _CHUNK:
        return f"get({_SPREAD_SQL}, CAST({value} AS INT))"
    pieces = (
        f"shiftleft(get({_SPREAD_SQL}, CAST(shiftright({value}, {start}) & {(1 << _CHUNK) - 1} AS INT)), {2 * start})"
        for start in range(0, depth, _CHUNK)
    )
    return f"({' | '.join(pieces)})"


def _pixel(face: str, ix: str, iy: str, depth: int) -> str:
    return (
        f"(shiftleft({face}, {2 * depth}) | {_spread_bits(f'({ix})', depth)}"
        f" | shiftleft({_spread_bits(f'({iy})', depth)}, 1))"
    )


def _index_sql(depth: int) -> str:
    """Pixel number from t (quarter turns), z (sine of latitude) and w (scaled polar distance)."""
    n = 1 << depth
    low = f"{n - 1}L"
    t, z, w = "__hpx_t", "__hpx_z", "__hpx_w"

    # belt between the polar caps: diagonal line numbers of the pixel, then its face
    down = f"floor({n}D * ({t} + 0.5D) - {0.75 * n}D * {z})"
    up = f"floor({n}D * ({t} + 0.5D) + {0.75 * n}D * {z})"
    face_down, face_up = f"shiftright({down}, {depth})", f"shiftright({up}, {depth})"
    column = f"(shiftright({face_down} + {face_up}, 1) & 3L)"
    belt = _pixel(
        f"({column} + ({face_down} - {face_up} + 1) * 4)", f"{up} & {low}", f"{low} - ({down} & {low})", depth
    )

    # caps: quarter of the sky, then the distance from the two edges of its face
    quarter = f"least(floor({t}), 3L)"
    first = f"least({low}, floor(({t} - {quarter}) * {w}))"
    second = f"least({low}, floor((1D - ({t} - {quarter})) * {w}))"
    north = _pixel(quarter, f"{low} - {second}", f"{low} - {first}", depth)
    south = _pixel(f"({quarter} + 8)", first, second, depth)
    return (
        f"CASE WHEN {t} IS NULL THEN NULL WHEN abs({z}) <= {2 / 3!r}D THEN {belt}"
        f" WHEN {z} > 0 THEN {north} ELSE {south} END"
    )


def with_healpix_index(
    ra: str, dec: str, depth: int = DEFAULT_DEPTH, out: str = "healpix_index"
) -> Callable[[DataFrame], DataFrame]:
    """Add the nested pixel number of (``ra``, ``dec``) in degrees.

    Null for null or NaN coordinates and for declinations outside [-90, 90]; any right
    ascension is taken modulo 360.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be 0..{MAX_DEPTH}, got {depth}")
    lon, lat = f"CAST(`{ra}` AS DOUBLE)", f"CAST(`{dec}` AS DOUBLE)"
    stages = {
        "__hpx_t": f"CASE WHEN {lat} BETWEEN -90D AND 90D AND NOT isnan({lon}) THEN pmod({lon}, 360D) / 90D END",
        "__hpx_z": f"sin(radians({lat}))",
        # n·sqrt(3(1-|z|)), written so that nothing cancels near the poles
        "__hpx_w": f"{(1 << depth) * math.sqrt(6.0)!r}D * sin(radians(90D - abs({lat})) / 2D)",
    }
    index = _index_sql(depth)

    def apply(df: DataFrame) -> DataFrame:
        columns = [f"`{c}`" for c in df.columns if c != out]
        staged = df.selectExpr(*columns, *(f"{sql} AS {name}" for name, sql in stages.items()))
        return staged.selectExpr(*columns, f"{index} AS `{out}`")

    return apply


def parent_pixel(pixel: Column, depth: int, parent_depth: int) -> Column:
    """Pixel number at a coarser depth; nesting makes this a shift."""
    if parent_depth > depth:
        raise ValueError("parent_depth must not exceed depth")
    return F.shiftright(pixel, 2 * (depth - parent_depth))


# --- from pixels back to the sphere ---------------------------------------------------------


def pixel_parts(pixel: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Face, column and row of nested pixel numbers."""
    pixel = np.asarray(pixel, np.int64)
    x, y = np.zeros_like(pixel), np.zeros_like(pixel)
    for b in range(depth):
        x |= ((pixel >> (2 * b)) & 1) << b
        y |= ((pixel >> (2 * b + 1)) & 1) << b
    return pixel >> (2 * depth), x, y


def pixel_vectors(face: np.ndarray, x: np.ndarray, y: np.ndarray, depth: int, at: tuple[float, float] = (0.5, 0.5)) -> np.ndarray:
    """Unit vectors of the centres of pixels, or of another point in them: ``at`` runs from 0 to 1 along column and row.

    The forward formulas solved for the position: in the caps the two distances from the edges of
    the face give the distance from the pole and the share of the quarter turn, in the belt the two
    diagonals give longitude and height.
    """
    n = float(1 << depth)
    i, j = x + at[0], y + at[1]
    quarter, ring = face & 3, face >> 2
    north, south = ring == 0, ring == 2
    first, second = np.where(north, n - j, i), np.where(north, n - i, j)
    w = first + second
    capped = (north | south) & (w < n)
    high = w * w / (3 * n * n)
    up, down = i / n + north, 1.0 - j / n + south
    z = np.where(capped, np.where(north, 1.0 - high, high - 1.0), (up - down) / 1.5)
    share = np.divide(first, w, out=np.zeros_like(w), where=w > 0)
    turn = (quarter + np.where(capped, share, (up + down - 1.0) / 2)) * (math.pi / 2)
    flat = np.sqrt(np.where(capped, high * (2.0 - high), np.maximum(0.0, 1.0 - z * z)))
    return np.stack((flat * np.cos(turn), flat * np.sin(turn), z), axis=-1)


def pixel_radius(depth: int) -> float:
    """Largest distance in degrees from the centre of any pixel of a depth to a point in it."""
    n = 1 << depth
    # the pixel whose corner touches the cap at the top of the belt reaches farthest
    far = (1.0 - 1.0 / n) ** 2
    z, turn = 2.0 / 3.0, math.pi / (4 * n)
    height = far / 3.0
    a = (math.sqrt(1 - z * z) * math.cos(turn), math.sqrt(1 - z * z) * math.sin(turn), z)
    b = (math.sqrt(height * (2 - height)), 0.0, 1.0 - height)
    half = math.dist(a, b) / 2
    return math.degrees(2 * math.asin(min(1.0, half)))


def pixel_width(depth: int) -> float:
    """Side in degrees of a square with the area of a pixel."""
    return math.degrees(math.sqrt(4 * math.pi / 12)) / (1 << depth)


def covered(
    centers: np.ndarray, reach: np.ndarray, stop: np.ndarray, whole: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which pixels hold positions within a chord of ``reach`` of unit vectors: (disc, pixel, depth, all inside).

    A descent from the twelve faces: pixels beyond a disc are dropped, the others divided down to the depth ``stop``
    of the disc; with ``whole`` those all inside it are left as they are. A pixel close to the rim may be given
    though it just misses the disc.
    """
    disc = np.repeat(np.arange(len(centers)), 12)
    face = np.tile(np.arange(12), len(centers))
    x, y, depth = np.zeros_like(face), np.zeros_like(face), 0
    found = []
    while True:
        vectors = pixel_vectors(face, x, y, depth)
        away = np.sqrt(((vectors - centers[disc]) ** 2).sum(axis=1))
        size = 2 * math.sin(math.radians(pixel_radius(depth)) / 2)
        near = away <= reach[disc] + size + 1e-15
        inside = near & (away <= reach[disc] - size) if whole else np.zeros(len(near), bool)
        ended = near & ((stop[disc] <= depth) | inside)
        number = _interleaved(face, x, y, depth)
        found.append((disc[ended], number[ended], np.full(int(ended.sum()), depth), inside[ended]))
        go = near & ~ended
        if not go.any():
            return tuple(np.concatenate(c) for c in zip(*found))
        disc, face, depth = np.repeat(disc[go], 4), np.repeat(face[go], 4), depth + 1
        step = np.tile(np.arange(4), int(go.sum()))
        x, y = np.repeat(x[go] * 2, 4) + (step & 1), np.repeat(y[go] * 2, 4) + (step >> 1)


def _interleaved(face: np.ndarray, x: np.ndarray, y: np.ndarray, depth: int) -> np.ndarray:
    number = face.astype(np.int64) << (2 * depth)
    for b in range(depth):
        number |= (((x >> b) & 1) << (2 * b)) | (((y >> b) & 1) << (2 * b + 1))
    return number


def disc_ranges(ra: float, dec: float, radius_deg: float, depth: int, detail: int = 3) -> list[tuple[int, int]]:
    """Ranges of nested pixels of ``depth`` that together hold every position within ``radius_deg`` of a centre.

    Pixels on the rim are divided until they are ``2 ** detail`` times narrower than the radius, and then named by their
    range or parent in ``depth``; so the number of ranges does not grow with the depth, and a small disc in a
    large pixel names that pixel alone. Ranges are ascending, inclusive and do not touch. No job is run.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be 0..{MAX_DEPTH}, got {depth}")
    lon, lat = math.radians(ra), math.radians(dec)
    center = np.array([[math.cos(lon) * math.cos(lat), math.sin(lon) * math.cos(lat), math.sin(lat)]])
    reach = np.array([2 * math.sin(math.radians(min(radius_deg, 180.0)) / 2)])
    _, pixel, order, _ = covered(center, reach, np.array([disc_order(radius_deg, detail)]), whole=True)
    down, up = 2 * np.maximum(depth - order, 0), 2 * np.maximum(order - depth, 0)
    lows, highs = (pixel << down) >> up, (((pixel + 1) << down) - 1) >> up
    highs = np.where(order > depth, lows, highs)
    ranges: list[tuple[int, int]] = []
    for low, high in sorted(zip(lows.tolist(), highs.tolist())):
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], high))
        else:
            ranges.append((low, high))
    return ranges


def disc_order(radius_deg: float, detail: int) -> int:
    """Depth of pixels about ``2 ** detail`` times narrower than ``radius_deg``."""
    if radius_deg <= 0:
        return MAX_DEPTH
    return max(0, min(MAX_DEPTH, math.ceil(math.log2(pixel_width(0) / radius_deg)) + detail))
