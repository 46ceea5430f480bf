"""Gold tables: the object dimension and the star fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.keys import business_key
from starloom.functions.sky import (
    ARCSEC,
    tangential_velocity,
    with_absolute_magnitudes,
    with_distance_parsec,
)
from starloom.operators.joins import join_astrometry_photometry
from starloom.operators.ranking import distinct_by_key
from starloom.operators.spatial import attach_nearest
from starloom.session import stage


def object_dimension(objects: DataFrame) -> DataFrame:
    """One row per object name with its business key; the latest load survives."""
    order = [F.col("fct_dt").desc(), F.col("ra").asc(), F.col("dec").asc()]
    return distinct_by_key(objects, ["main_id"], order).select(
        "main_id", "ra", "dec", "healpix_index", business_key("main_id", "ra", "dec").alias("bk_simbad")
    )


def star_facts(
    astrometry: DataFrame,
    photometry: DataFrame,
    objects: DataFrame,
    tolerance_deg: float = ARCSEC,
    mode: str = "pixel",
    unreliable_as_null: bool = False,
    corrected_velocity: bool = False,
    staged: bool = True,
) -> DataFrame:
    """One row per star with magnitudes, distance, velocity and its nearest object.

    The joined stars are staged, as the match and the rows both read them; the match then reads its six columns
    only. Silver tables published with :func:`starloom.sources.tables.publish_by_key` need no ``staged``: their join is
    a scan without a shuffle, and so are the wide rows that the matches are attached to.

    See :func:`starloom.operators.spatial.counterparts` for the two match modes. Derived
    quantities depend on the star alone and are computed after the match, so that the
    shuffles carry measured columns only.
    """
    stars = join_astrometry_photometry(astrometry, photometry)
    if staged:
        stars = stage(stars, "gold-stars")
    best = attach_nearest(stars, objects, tolerance_deg, mode)
    derived = (
        best.transform(with_distance_parsec("parallax", "is_reliable_plx"))
        .transform(with_absolute_magnitudes("j_m", "h_m", "ks_m", "distance_pc", unreliable_as_null))
        .withColumn("tangential_velocity", tangential_velocity("distance_pc", "pmra", "pmdec", corrected_velocity))
    )
    return derived.select(
        *("source_id", "j_m", "h_m", "ks_m", "parallax", "parallax_error", "pmra", "pmdec", "ruwe"),
        *("healpix_index", "ra", "dec", "bk_simbad"),
        *(F.col(f"{c}_unit").alias(c) for c in ("x", "y", "z")),
        *("color_j_h", "color_h_ks", "distance_pc", "abs_mag_j", "abs_mag_h", "abs_mag_ks", "tangential_velocity"),
    )


def served_ids(spark: SparkSession, table: str, n: int = 10) -> DataFrame:
    """The first ids of a published fact table."""
    return spark.table(table).select("source_id").orderBy("source_id").limit(n)
