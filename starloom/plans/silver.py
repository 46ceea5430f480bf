"""Silver tables: astrometry, photometry and catalogue objects.

Each ``*_rows`` function is the pure transformation of bronze rows; :func:`publish` writes
any of them to its table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.healpix import parent_pixel, with_healpix_index
from starloom.functions.keys import date_key
from starloom.functions.sky import reliable_astrometry, reliable_parallax, with_unit_vectors
from starloom.operators.metrics import observed
from starloom.operators.ranking import keep_latest
from starloom.operators.shape import assert_schema, union_all_by_name
from starloom.sources.catalogs import ASTROMETRY, PHOTOMETRY
from starloom.sources.tables import overwrite_partitions, sync_table

#: Partition column of published tables, a pixel of this order.
TILE, TILE_ORDER = "sky_tile", 2


def _known_sources(sources: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Union of the sources cut to ``columns``, without rows that have no source id."""
    return union_all_by_name([s.select(*columns) for s in sources]).filter(F.col("source_id").isNotNull())


def astrometry_rows(*sources: DataFrame, latest: bool = True) -> DataFrame:
    """Positions, parallaxes and motions with pixel, unit vector and quality flags."""
    measured = ("ra", "dec", "parallax", "parallax_error", "pmra", "pmdec", "ruwe")
    rows = _known_sources(sources, ("source_id", *measured, "year", "month", "day"))
    rows = rows.withColumn("fct_dt", date_key("year", "month", "day")).drop("year", "month", "day")
    # everything below is derived from the kept row, so the repeats go first
    rows = keep_latest(rows, tie_breakers=measured) if latest else rows
    rows = rows.transform(with_healpix_index("ra", "dec")).transform(with_unit_vectors("ra", "dec"))
    rows = rows.withColumns(
        {
            "is_reliable_astro": reliable_astrometry("ruwe"),
            "is_reliable_plx": reliable_parallax("parallax", "parallax_error"),
        }
    )
    derived = ("x_unit", "y_unit", "z_unit", "is_reliable_astro", "is_reliable_plx")
    return assert_schema(rows.select(*ASTROMETRY.names, *derived), ASTROMETRY)


def photometry_rows(*sources: DataFrame, latest: bool = True) -> DataFrame:
    """Infrared magnitudes with pixel and colours."""
    measured = ("j_m", "h_m", "ks_m")
    rows = _known_sources(sources, ("source_id", *measured, "year", "month", "day", "ra", "dec"))
    rows = rows.withColumn("fct_dt", date_key("year", "month", "day")).drop("year", "month", "day")
    rows = keep_latest(rows, tie_breakers=(*measured, "ra", "dec")) if latest else rows
    rows = rows.transform(with_healpix_index("ra", "dec")).withColumns(
        {
            "color_j_h": F.col("j_m") - F.col("h_m"),
            "color_h_ks": F.col("h_m") - F.col("ks_m"),
        }
    )
    return assert_schema(rows.select(*PHOTOMETRY.names, "ra", "dec", "color_j_h", "color_h_ks"), PHOTOMETRY)


def object_rows(bronze: DataFrame) -> DataFrame:
    """Catalogue objects with trimmed names and pixel; repeats are kept."""
    rows = bronze.select("main_id", "ra_deg", "dec_deg", "year", "month", "day")
    return rows.transform(with_healpix_index("ra_deg", "dec_deg")).select(
        F.trim("main_id").alias("main_id"),
        F.col("ra_deg").alias("ra"),
        F.col("dec_deg").alias("dec"),
        date_key("year", "month", "day").alias("fct_dt"),
        "healpix_index",
    )


def publish(
    df: DataFrame,
    table: str,
    partition_cols: Sequence[str] | None = None,
    sort_cols: Sequence[str] = ("healpix_index",),
    purge_key: str | None = None,
) -> dict[str, object]:
    """Create or evolve ``table``, replace the partitions that occur in ``df``, and return the number of records published.

    By default rows are partitioned by ``sky_tile``, the order-2 pixel around them: at most 192
    folders for the whole sky, where the order-6 pixel would make 49,152.
    """
    if partition_cols is None:
        partition_cols = (TILE,)
        df = df.withColumn(TILE, parent_pixel(F.col("healpix_index"), 6, TILE_ORDER))
    sync_table(df, table, partition_cols, sort_cols)
    return observed(df, lambda rows: overwrite_partitions(rows, table, purge_key))
