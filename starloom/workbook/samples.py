"""Sky tables computed from the test tables, every row of them.

Positions are integers divided by powers of ten, so that any engine computes the same
doubles. k stands for the key of the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scatter(k: str, factor: int, modulus: int, start: int) -> str:
    """Start plus a well-mixed integer below ``modulus``, in units of 1e-7 degrees."""
    return f"({start}L + (({k}) % {modulus}L) * {factor}L % {modulus}L)"


def _position(k: str, wide: bool, shift: int = 0) -> tuple[str, str]:
    """Right ascension and declination of key k: a 36° × 16° band, or nearly the whole sphere."""
    if wide:
        ra = _scatter(k, 87178291, 3599900009, 20000)
        dec = _scatter(k, 39916801, 1790000003, -895000000)
        # engines print numbers below 0.001 differently, which would show in md5 keys
        dec = f"({dec} + IF({dec} >= 0, 100000L, -100000L))"
    else:
        ra = _scatter(k, 87178291, 360000007, 100000000)
        dec = _scatter(k, 39916801, 160000003, 120000000)
    return f"({ra} + {shift}) / 1e7D", f"({dec} - {shift}) / 1e7D"


def stars(spark: SparkSession, sf_dir: str, wide: bool = False, observation: int = 1) -> DataFrame:
    """Star rows from ``orders``.

    ``observation=2`` is a second look at the same stars: dates shifted by up to three days
    either way, slightly other values, and no source id for some rows. Some motions are null,
    some NaN.
    """
    second = observation == 2
    ra, dec = _position("o_orderkey", wide)
    k, bump = "o_orderkey", 1 if second else 0
    day = "date_add(to_date(o_orderdate), CAST(o_orderkey % 7 - 3 AS INT))" if second else "to_date(o_orderdate)"
    j = "(5 + (o_custkey % 1000) / 100D)"
    h = f"({j} - ({k} % 70) / 100D)"
    return table(spark, sf_dir, "orders").selectExpr(
        f"{f'IF({k} % 53 != 0, {k}, NULL)' if second else k} AS source_id",
        f"{ra} AS ra",
        f"{dec} AS dec",
        f"IF({k} % 97 != 0, ({k} * 31 % 400 - 50 + {bump}) / 10D, NULL) AS parallax",
        f"0.05D + ({k} % 20) / 20D AS parallax_error",
        f"IF({k} % 101 = 0, double('NaN'), IF({k} % 17 != 0, ({k} * 13 % 2001 - 1000 + {bump}) / 10D, NULL)) AS pmra",
        f"IF({k} % 19 != 0, ({k} * 11 % 2001 - 1000) / 10D, NULL) AS pmdec",
        f"0.8D + ({k} % 15) / 10D AS ruwe",
        f"8 + ({k} % 1200) / 100D AS phot_g_mean_mag",
        f"9 + ({k} % 1100) / 100D AS phot_bp_mean_mag",
        f"7 + ({k} % 1300) / 100D AS phot_rp_mean_mag",
        f"CAST({j} AS FLOAT) AS j_m",
        f"CAST({h} AS FLOAT) AS h_m",
        f"CAST({h} - ({k} % 30) / 100D AS FLOAT) AS ks_m",
        f"year({day}) AS year",
        f"month({day}) AS month",
        f"day({day}) AS day",
    )


def objects(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Bronze catalogue objects: one per customer, 0.36″ from the star with ten times its key,
    and a later look at the objects whose key is also a supplier's."""

    def rows(name: str, key: str, first_year: int, shift: int) -> DataFrame:
        ra, dec = _position(f"{key} * 10", wide, shift)
        return table(spark, sf_dir, name).selectExpr(
            f"concat('  C', {key}, ' ') AS main_id",
            f"{ra} AS ra_deg",
            f"{dec} AS dec_deg",
            f"CAST({first_year} + {key} % 3 AS INT) AS year",
            f"CAST(1 + {key} % 12 AS INT) AS month",
            f"CAST(1 + {key} % 28 AS INT) AS day",
        )

    return rows("customer", "c_custkey", 2019, 1000).unionByName(rows("supplier", "s_suppkey", 2020, 500))


def centers(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """One named position per customer."""
    ra, dec = _position("c_custkey * 10", wide, 1000)
    return table(spark, sf_dir, "customer").selectExpr("concat('C', c_custkey) AS main_id", f"{ra} AS ra", f"{dec} AS dec")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star to neighbour links from ``lineitem``; a star has several or none."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS source_id", "l_partkey AS clean_tmass_psc_xsc_oid", "l_discount AS angular_distance"
    )


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS clean_tmass_psc_xsc_oid", "concat('T', floor(p_partkey / 16D)) AS original_psc_source_id"
    )


def infrared(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = "5 + (s_suppkey % 700) / 100D"
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('T', s_suppkey) AS designation",
        f"CAST({j} AS FLOAT) AS j_m",
        f"CAST({j} - 0.25D AS FLOAT) AS h_m",
        f"CAST({j} - 0.5D AS FLOAT) AS ks_m",
    )


def planets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planet records from ``part``; mass, method and discovery year are sometimes missing."""
    ra, dec = _position("p_partkey", True)
    return table(spark, sf_dir, "part").selectExpr(
        "p_name AS pl_name",
        "IF(p_partkey % 11 != 0, p_retailprice, NULL) AS pl_masse",
        "p_brand AS hostname",
        f"{ra} AS ra",
        f"{dec} AS dec",
        "concat('G ', lpad(p_partkey, 12, '0')) AS gaia_dr3_id",
        "CAST(1 + p_partkey % 3 AS INT) AS sy_snum",
        "CAST(p_partkey % 2 AS INT) AS sy_mnum",
        "CAST(p_size AS INT) AS sy_pnum",
        "p_type AS soltype",
        "IF(p_partkey % 7 != 0, 'Transit', NULL) AS discoverymethod",
        "IF(p_partkey % 13 != 0, CAST(1995 + p_partkey % 30 AS INT), NULL) AS disc_year",
        "'Ground' AS disc_locale",
        "concat('Telescope ', p_size) AS disc_telescope",
        "CAST(p_partkey % 2 AS INT) AS obm_flag",
        "CAST(p_partkey % 5 AS INT) AS micro_flag",
        "'2024-01-01' AS releasedate",
        "CAST(p_partkey % 360 AS DOUBLE) AS elon",
        "CAST(p_partkey % 90 AS DOUBLE) AS elat",
    )
