"""Raw extracts: stars with photometry in a cone, and the stars around catalogue objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import counterpart_chain
from starloom.operators.spatial import cone_search, nearest_within, valid_coordinates
from starloom.sources.catalogs import star_extract

# Fixed values of the extract: centre 02h07m10.40s +23d27m44.7s and radii in degrees.
CENTER = ((2 + 7 / 60 + 10.40 / 3600) * 15, 23 + 27 / 60 + 44.7 / 3600)
CONE_RADIUS = 5.0
PAIR_RADIUS = 1.0


def individual_extract(
    stars: DataFrame,
    neighbours: DataFrame,
    bridge: DataFrame,
    photometry: DataFrame,
    center: tuple[float, float] = CENTER,
    radius_deg: float = CONE_RADIUS,
) -> DataFrame:
    """Stars of the cone with their infrared photometry. The cone is cut before the joins."""
    inside = stars.transform(valid_coordinates()).transform(cone_search(*center, radius_deg))
    return star_extract(counterpart_chain(inside, neighbours, bridge, photometry))


def object_extract(
    objects: DataFrame, center: tuple[float, float] = CENTER, radius_deg: float = CONE_RADIUS
) -> DataFrame:
    """Objects of the cone: ``main_id``, ``ra_deg``, ``dec_deg``."""
    return (
        objects.transform(valid_coordinates())
        .transform(cone_search(*center, radius_deg))
        .select("main_id", F.col("ra").alias("ra_deg"), F.col("dec").alias("dec_deg"))
    )


def cluster_extract(star_rows: DataFrame, objects: DataFrame, radius_deg: float = PAIR_RADIUS) -> DataFrame:
    """The rows of the extract within ``radius_deg`` of an object: labelled with the nearest, and how many there are.

    The historic extract repeated a star for every object in reach; later steps keep one row
    per star and no label, so here a row stays one row.
    """
    places = objects.select("main_id", F.col("ra_deg").alias("ra"), F.col("dec_deg").alias("dec"))
    return nearest_within(star_rows, places, radius_deg, out=("n_objects", "source_cluster")).where("n_objects > 0")


def write_extract(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
