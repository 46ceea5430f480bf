"""Equi-joins of the catalogue pipelines.

None carries a broadcast hint: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``. Hot keys are split by AQE's skew join, which can
split either side of an inner join but only the left side of a left or anti join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import stage

#: Rows of one key that a task should not have to hold.
HOT_ROWS = 1_000_000


def left_join_fan_out(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join for a right side whose keys may repeat without limit.

    A plain left join cannot split a hot right-hand key. Keys with more than ``hot_rows`` rows
    on the right are counted first; as they have a counterpart, an inner join does for them,
    and that can be split. All other keys take the plain left join, which is all there is to do
    where no key is hot.
    """
    hot = stage(right.groupBy(key).count().where(F.col("count") > hot_rows).where(F.col(key).isNotNull()).select(key), "hot-keys")
    if hot.isEmpty():
        return left.join(right, key, "left")
    plain = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, "left")
    spread = left.join(hot, key, "left_semi").join(right.join(hot, key, "left_semi"), key, "inner")
    return plain.unionByName(spread)


def join_astrometry_photometry(astrometry: DataFrame, photometry: DataFrame) -> DataFrame:
    """Inner join on ``source_id``; position and pixel come from the astrometry first."""
    a, p = astrometry.alias("a"), photometry.alias("p")
    either = [F.coalesce(F.col(f"a.{c}"), F.col(f"p.{c}")).alias(c) for c in ("ra", "dec", "healpix_index")]
    return a.join(p, F.col("a.source_id") == F.col("p.source_id"), "inner").select(
        "a.source_id",
        *(f"p.{c}" for c in ("j_m", "h_m", "ks_m", "color_j_h", "color_h_ks")),
        *(f"a.{c}" for c in ("parallax", "parallax_error", "is_reliable_plx", "pmra", "pmdec", "ruwe")),
        *(f"a.{c}" for c in ("x_unit", "y_unit", "z_unit")),
        *either,
    )


def counterpart_chain(
    stars: DataFrame, neighbours: DataFrame, bridge: DataFrame, photometry: DataFrame
) -> DataFrame:
    """Stars with their infrared photometry: source → neighbour → bridge → photometry.

    Three left joins, so every star is kept. A star may have any number of neighbours
    (first join); the keys of the other two tables are meant to be unique, and stars without
    a neighbour share the null key there, which sits on the splittable left side.
    """
    link = neighbours.select(
        "source_id", "clean_tmass_psc_xsc_oid", F.col("angular_distance").alias("angular_distance_arcsec")
    )
    return (
        left_join_fan_out(stars, link, "source_id")
        .join(bridge.select("clean_tmass_psc_xsc_oid", "original_psc_source_id"), "clean_tmass_psc_xsc_oid", "left")
        .join(
            photometry.select(F.col("designation").alias("original_psc_source_id"), "j_m", "h_m", "ks_m"),
            "original_psc_source_id",
            "left",
        )
        .drop("clean_tmass_psc_xsc_oid", "original_psc_source_id")
    )


def pixel_candidates(stars: DataFrame, objects: DataFrame, pixel: str = "healpix_index") -> DataFrame:
    """Left join on the pixel, reduced to what each pixel offers.

    Pairing every star with every object of its pixel grows with the square of the density.
    The objects are therefore summed up per pixel first: one row per star, with the number
    of candidates and the first and last key (0 and nulls where the pixel is empty).
    """
    summary = objects.groupBy(pixel).agg(
        F.count("*").alias("candidates"), F.min("bk_simbad").alias("first_bk"), F.max("bk_simbad").alias("last_bk")
    )
    return stars.join(summary, pixel, "left").withColumn("candidates", F.coalesce("candidates", F.lit(0).cast("long")))
