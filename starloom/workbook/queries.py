"""The registered queries. Every one runs over whole test tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import sky
from starloom.functions.healpix import parent_pixel, with_healpix_index
from starloom.functions.keys import date_key, match_or_sentinel
from starloom.operators import joins, ranking, shape, spatial
from starloom.operators.batches import as_messages, batch_records
from starloom.operators.metrics import observed
from starloom.plans import gold, publishing, raw, silver
from starloom.session import scratch_path, shared_dir, stage
from starloom.sources import bronze, catalogs, control, files, jsonrecords, tables
from starloom.streaming import landing
from starloom.workbook import samples

LOAD_DATE = dt.date(2026, 6, 19)

Query = Callable[[SparkSession, str], DataFrame]


_POSITIONS = ("ra", "dec", "ra_r", "dec_r")


def _round(df: DataFrame, digits: int = 9, **special: int) -> DataFrame:
    """Fractional columns rounded, so that the last bit of a cosine does not matter.

    Positions have seven decimals and always keep nine.
    """
    places = {**dict.fromkeys(_POSITIONS, 9), **special}
    return df.selectExpr(
        *(
            f"round(CAST(`{f.name}` AS DOUBLE), {places.get(f.name, digits)}) AS `{f.name}`"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else f"`{f.name}`"
            for f in df.schema.fields
        )
    )


# --- scalar functions -----------------------------------------------------------------


def healpix_index(spark: SparkSession, sf: str) -> DataFrame:
    df = samples.stars(spark, sf, wide=True).select("source_id", "ra", "dec")
    df = df.transform(with_healpix_index("ra", "dec")).transform(with_healpix_index("ra", "dec", 10, "healpix_10"))
    return df.select("source_id", "healpix_index", "healpix_10", parent_pixel(F.col("healpix_index"), 6, 3).alias("healpix_3"))


def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    df = samples.stars(spark, sf, wide=True).select("source_id", "ra", "dec")
    return _round(df.transform(sky.with_unit_vectors("ra", "dec")).select("source_id", "x_unit", "y_unit", "z_unit"))


def angular_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Each star against its place at the other epoch and against a far point."""
    df = samples.stars(spark, sf).select("source_id", "ra", "dec", "pmra", "pmdec")
    df = df.transform(sky.with_propagated_position("ra", "dec", "pmra", "pmdec"))
    df = df.transform(sky.with_separation("ra", "dec", "ra_prop", "dec_prop"))
    df = df.transform(sky.with_separation("ra", "dec", "ra_prop", "dec_prop", exact=True, out="exact_d"))
    far = sky.great_circle_separation("ra", "dec", F.lit(200.0), F.lit(-45.0))
    return _round(df.select("source_id", "threshold_angular_d", "exact_d", far.alias("far_d")), far_d=7)


def _with_distance(spark: SparkSession, sf: str) -> DataFrame:
    df = samples.stars(spark, sf)
    df = df.withColumn("is_reliable_plx", sky.reliable_parallax("parallax", "parallax_error"))
    return df.transform(sky.with_distance_parsec("parallax", "is_reliable_plx"))


def distance_pc(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_with_distance(spark, sf).select("source_id", "distance_pc"))


def absolute_magnitude(spark: SparkSession, sf: str) -> DataFrame:
    df = _with_distance(spark, sf).transform(sky.with_absolute_magnitudes("j_m", "h_m", "ks_m", "distance_pc"))
    known = sky.absolute_magnitude("j_m", "distance_pc", unreliable_as_null=True)
    return _round(df.select("source_id", "abs_mag_j", "abs_mag_h", "abs_mag_ks", known.alias("known_mag_j")), 6)


def propagate_motion(spark: SparkSession, sf: str) -> DataFrame:
    df = samples.stars(spark, sf).select("source_id", "ra", "dec", "pmra", "pmdec")
    return _round(
        df.transform(sky.with_propagated_position("ra", "dec", "pmra", "pmdec")).select("source_id", "ra_prop", "dec_prop")
    )


def tangential_velocity(spark: SparkSession, sf: str) -> DataFrame:
    df = _with_distance(spark, sf)
    return _round(
        df.select(
            "source_id",
            sky.tangential_velocity("distance_pc", "pmra", "pmdec").alias("tangential_velocity"),
            sky.tangential_velocity("distance_pc", "pmra", "pmdec", corrected=True).alias("velocity_km_s"),
        ),
        7,
    )


def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    return samples.stars(spark, sf).select(
        "source_id",
        sky.reliable_astrometry("ruwe").alias("is_reliable_astro"),
        sky.reliable_parallax("parallax", "parallax_error").alias("is_reliable_plx"),
    )


def _two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def sexagesimal_to_deg(spark: SparkSession, sf: str) -> DataFrame:
    """Position texts built from the keys, such as 02h07m10.40s and -23d27m44.7s."""
    k = F.col("o_orderkey")
    ra = F.concat(
        *(_two_digits(k % 24), F.lit("h"), _two_digits(k % 60), F.lit("m")),
        *(_two_digits((k * 7) % 60), F.lit("."), _two_digits((k * 3) % 100), F.lit("s")),
    )
    dec = F.concat(
        *(F.when(k % 2 == 0, "+").otherwise("-"), _two_digits(k % 90), F.lit("d"), _two_digits(k % 60), F.lit("m")),
        *(_two_digits((k * 11) % 60), F.lit("."), ((k * 3) % 10).cast("string"), F.lit("s")),
    )
    df = samples.table(spark, sf, "orders").select(k.alias("source_id"), ra.alias("ra_text"), dec.alias("dec_text"))
    return _round(
        df.select(
            "source_id",
            "ra_text",
            "dec_text",
            sky.sexagesimal_to_degrees("ra_text").alias("ra"),
            sky.sexagesimal_to_degrees("dec_text").alias("dec"),
        )
    )


def date_keys(spark: SparkSession, sf: str) -> DataFrame:
    return samples.stars(spark, sf).select("source_id", date_key("year", "month", "day").alias("fct_dt"))


# --- ranking and unions ---------------------------------------------------------------


def _two_observations(spark: SparkSession, sf: str) -> DataFrame:
    both = shape.union_all_by_name([samples.stars(spark, sf), samples.stars(spark, sf, observation=2)])
    return both.withColumn("fct_dt", date_key("year", "month", "day"))


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_two_observations(spark, sf).select("source_id", "ra", "dec", "parallax", "fct_dt"))


def keep_latest(spark: SparkSession, sf: str) -> DataFrame:
    df = _two_observations(spark, sf).filter(F.col("source_id").isNotNull())
    df = df.select("source_id", "fct_dt", "parallax", "pmra")
    return _round(ranking.keep_latest(df))


def nearest_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Best link per star over all of ``lineitem``: smallest distance, then smallest key."""
    links = samples.neighbours(spark, sf).select(
        "source_id",
        F.col("angular_distance").alias("threshold_angular_d"),
        F.concat(F.lit("P"), F.lpad(F.col("clean_tmass_psc_xsc_oid").cast("string"), 12, "0")).alias("bk_simbad"),
    )
    best = ranking.nearest_by(links, "source_id", "threshold_angular_d", "bk_simbad")
    return best.withColumn("bk_simbad", match_or_sentinel("bk_simbad", "threshold_angular_d", 0.05))


# --- silver and gold ------------------------------------------------------------------


def _astrometry(spark: SparkSession, sf: str, wide: bool = False) -> DataFrame:
    return silver.astrometry_rows(*(samples.stars(spark, sf, wide, n) for n in (1, 2)))


def _photometry(spark: SparkSession, sf: str, wide: bool = False) -> DataFrame:
    return silver.photometry_rows(*(samples.stars(spark, sf, wide, n) for n in (1, 2)))


def _dimension(spark: SparkSession, sf: str, wide: bool = False) -> DataFrame:
    return gold.object_dimension(silver.object_rows(samples.objects(spark, sf, wide)))


def silver_astrometry(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_astrometry(spark, sf))


def silver_photometry(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_photometry(spark, sf), 6)


def silver_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _round(silver.object_rows(samples.objects(spark, sf)))


def dim_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_dimension(spark, sf))


BUCKETS = 8  # of the silver tables that are published by key


def gold_fact(spark: SparkSession, sf: str) -> DataFrame:
    facts = gold.star_facts(_astrometry(spark, sf), _photometry(spark, sf), _dimension(spark, sf))
    return _round(facts, 6, tangential_velocity=7)


def _by_key(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The silver star tables, published in buckets of the source id."""
    made = []
    for name, rows in (("astrometry", _astrometry(spark, sf)), ("photometry", _photometry(spark, sf))):
        table = f"{_database(spark)}.{name}"
        tables.publish_by_key(rows, table, "source_id", BUCKETS)
        made.append(spark.table(table))
    return made


def gold_fact_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The gold table from published silver tables, whose wide rows are not shuffled again."""
    facts = gold.star_facts(*_by_key(spark, sf), _dimension(spark, sf), staged=False)
    return _round(facts, 6, tangential_velocity=7)


def gold_fact_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The same over the whole sphere with great-circle matching."""
    facts = gold.star_facts(
        _astrometry(spark, sf, True), _photometry(spark, sf, True), _dimension(spark, sf, True), mode="exact"
    )
    return facts.select("source_id", "bk_simbad", "healpix_index")


# --- raw extracts ---------------------------------------------------------------------


def _links(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return samples.neighbours(spark, sf), samples.bridge(spark, sf), samples.infrared(spark, sf)


def _bare_stars(spark: SparkSession, sf: str) -> DataFrame:
    return samples.stars(spark, sf).drop("j_m", "h_m", "ks_m", "year", "month", "day")


def left_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    chained = joins.counterpart_chain(_bare_stars(spark, sf), *_links(spark, sf))
    return _round(chained.select("source_id", "angular_distance_arcsec", "j_m", "h_m", "ks_m"), 6)


def raw_individual_extract(spark: SparkSession, sf: str) -> DataFrame:
    return _round(raw.individual_extract(_bare_stars(spark, sf), *_links(spark, sf)), 6)


def raw_cluster_extract(spark: SparkSession, sf: str) -> DataFrame:
    """The star extract is written first, as its own product, and then paired."""
    path = scratch_path(spark, "extract")
    raw.write_extract(raw_individual_extract(spark, sf), path)
    return raw.cluster_extract(spark.read.parquet(path), raw.object_extract(samples.centers(spark, sf)))


# --- joins ----------------------------------------------------------------------------


def join_astro_photo(spark: SparkSession, sf: str) -> DataFrame:
    return _round(joins.join_astrometry_photometry(_astrometry(spark, sf), _photometry(spark, sf)), 6)


def _pixel_stars(spark: SparkSession, sf: str) -> DataFrame:
    return (
        samples.stars(spark, sf)
        .select("source_id", "ra", "dec", "pmra", "pmdec")
        .transform(with_healpix_index("ra", "dec"))
    )


def join_pixel_left(spark: SparkSession, sf: str) -> DataFrame:
    """Stars with the objects of their pixel that lie within 5″; all stars are kept."""
    stars, dimension = _pixel_stars(spark, sf), _dimension(spark, sf)
    matched = spatial.attach_counterparts(stars, dimension, 5 * sky.ARCSEC, distinct_positions=False)
    return _round(matched.select("source_id", "healpix_index", "bk_simbad", "threshold_angular_d"))


def pixel_candidates(spark: SparkSession, sf: str) -> DataFrame:
    found = joins.pixel_candidates(_pixel_stars(spark, sf), _dimension(spark, sf))
    return found.select("source_id", "healpix_index", "candidates", "first_bk", "last_bk")


DENSE_ROWS = 12.0  # stars that a cone of the density extract is expected to hold

# --- sky search -----------------------------------------------------------------------


def valid_coords(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with both coordinates, after some were blanked (null or NaN) by key."""
    k = F.col("source_id")
    df = samples.stars(spark, sf).select(
        "source_id",
        F.when(k % 23 != 0, F.col("ra")).alias("ra"),
        F.when(k % 29 == 0, F.lit(float("nan"))).otherwise(F.col("dec")).alias("dec"),
    )
    return _round(df.transform(spatial.valid_coordinates()))


def cone_search(spark: SparkSession, sf: str) -> DataFrame:
    df = samples.stars(spark, sf, wide=True).select("source_id", "ra", "dec")
    return _round(df.transform(spatial.cone_search(2.0, 80.0, 15.0)))


def cone_search_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The same cone in a table laid out by tile: only covering tiles and row groups with its pixels are opened."""
    table = f"{_database(spark)}.sky"
    df = samples.stars(spark, sf, wide=True).select("source_id", "ra", "dec")
    silver.publish(df.transform(with_healpix_index("ra", "dec")), table)
    laid_out = [(silver.TILE, silver.TILE_ORDER), ("healpix_index", 6)]
    found = spark.table(table).transform(spatial.cone_search(2.0, 80.0, 15.0, pixels=laid_out))
    return _round(found.select("source_id", "ra", "dec"))


def cone_count(spark: SparkSession, sf: str) -> DataFrame:
    stars, around = samples.stars(spark, sf), samples.centers(spark, sf)
    return _round(spatial.count_in_cones(stars, around, 1.0))


def density_radius(spark: SparkSession, sf: str) -> DataFrame:
    stars, around = samples.stars(spark, sf), samples.centers(spark, sf)
    return _round(spatial.density_radius(spatial.count_in_cones(stars, around, spatial.DENSITY_TEST_RADIUS)))


def density_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Stars of cones that are as wide as the sources around their centre are rare: a dozen stars each, or two degrees in empty fields."""
    stars = samples.stars(spark, sf).select("source_id", "ra", "dec")
    around = samples.centers(spark, sf)
    counted = spatial.count_in_cones(stars, around, spatial.DENSITY_TEST_RADIUS)
    cones = spatial.density_radius(counted, on_empty="largest", target_rows=DENSE_ROWS)
    cones = cones.select("main_id", F.col("ra").alias("ra_r"), F.col("dec").alias("dec_r"), "radius_deg")
    return _round(spatial.pairs_in_cones(stars, cones).select("main_id", "source_id", "radius_deg"))


def sky_pairs_within(spark: SparkSession, sf: str) -> DataFrame:
    """Each star with the number of positions within a degree and the name of the nearest."""
    stars = samples.stars(spark, sf, wide=True).select("source_id", "ra", "dec")
    return _round(spatial.nearest_within(stars, samples.centers(spark, sf, wide=True), 1.0))


# --- shapes ---------------------------------------------------------------------------

CONFORM_TARGET = catalogs.flat_schema(
    "o_orderkey int, o_custkey double, o_totalprice bigint, o_orderdate string, o_orderpriority string, clerk string"
)


def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Orders forced to another schema; prices with cents do not fit and are marked."""
    orders = samples.table(spark, sf, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 4 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice"))
    )
    orders = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    marked = shape.conform(orders, CONFORM_TARGET, on_loss="mark")
    return marked.withColumn("cast_errors", F.concat_ws(",", shape.CAST_ERRORS)).drop(shape.CAST_ERRORS)


def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    df = samples.stars(spark, sf).withColumn("fct_dt", date_key("year", "month", "day"))
    df = df.transform(with_healpix_index("ra", "dec"))
    checked = shape.assert_schema(df, catalogs.PHOTOMETRY)
    return _round(checked.select("source_id", "j_m", "h_m", "ks_m", "fct_dt", "healpix_index"), 6)


def catalog_projection(spark: SparkSession, sf: str) -> DataFrame:
    return _round(catalogs.planet_catalog(samples.planets(spark, sf)))


def serve_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids from the published fact table, which is made once and then only read."""
    facts = gold.star_facts(_astrometry(spark, sf), _photometry(spark, sf), _dimension(spark, sf))
    table = f"{_database(spark)}.facts"
    silver.publish(facts, table)
    return gold.served_ids(spark, table)


# --- sources --------------------------------------------------------------------------


def csv_infer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV with comments, three null tokens, quotes, line breaks and two column orders, read back with inferred types."""
    k = F.col("o_orderkey")
    token = F.when(k % 3 == 0, "NULL").when(k % 3 == 1, "null").otherwise("")
    rows = samples.table(spark, sf, "orders").select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 10 == 0, token).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(k % 15 == 1, token).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 20 == 2, token).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        (k % 2 == 0).cast("string").alias("is_even"),
        F.concat(F.lit('say "'), "o_orderpriority", F.lit('", now'), F.when(k % 7 == 0, F.lit("\n or never")).otherwise("")).alias("remark"),
    )
    comments = samples.table(spark, sf, "supplier").select(
        F.concat(F.lit("# checked by "), "s_name").alias("o_orderkey"),
        *(F.lit("x").alias(c) for c in rows.columns[1:]),
    )
    path = scratch_path(spark, "csv")
    # another comment sign for the writer, which would put quotes around "#" otherwise
    options = dict(header=True, emptyValue="", escape='"')
    rows.where(k % 5 != 0).unionByName(comments).write.option("comment", "~").csv(f"{path}/forth", **options)
    rows.where(k % 5 == 0).select(*reversed(rows.columns)).write.csv(f"{path}/back", **options)
    return files.read_csv_inferred(spark, path)


def scan_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """Three nested folders, one of them with JSON, read as one Parquet prefix."""
    root = scratch_path(spark, "tree")
    orders = samples.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    early = F.col("o_totalprice") < 150000
    orders.filter(early).write.parquet(f"{root}/a/2020")
    orders.filter(~early).write.parquet(f"{root}/b/x/y")
    orders.write.json(f"{root}/ps/landed")
    return files.read_parquet_tree(spark, root)


CONFORM_FILES_TARGET = catalogs.flat_schema("o_orderkey bigint, o_custkey double, o_totalprice double, o_orderstatus string")


def conform_files(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files with int and bigint, float and double, missing and surplus columns, one of them without a suffix."""
    root = scratch_path(spark, "kinds")
    orders = samples.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    plain = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    plain.where(k % 3 == 0).write.parquet(f"{root}/a")
    narrow = plain.where(k % 3 == 1).withColumns({"o_orderkey": k.cast("int"), "o_totalprice": F.floor("o_totalprice").cast("float")})
    narrow.drop("o_orderstatus").write.parquet(f"{root}/b/deep")
    orders.where(k % 3 == 2).drop("o_totalprice").coalesce(1).write.parquet(f"{root}/c")
    orders.write.json(f"{root}/d")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/c")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    fs.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{root}/c/an object 100%"))
    return bronze.conform_files(spark, root, CONFORM_FILES_TARGET)


def scan_merge_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Partition folders whose files differ in their columns, read under one schema."""
    root = scratch_path(spark, "merge")
    orders = samples.table(spark, sf, "orders")
    orders.select("o_orderkey", "o_custkey").write.parquet(f"{root}/year=1999")
    orders.select("o_orderkey", "o_totalprice").write.parquet(f"{root}/year=2000")
    return files.read_parquet(spark, root, ["o_orderkey", "o_custkey", "o_totalprice", "year"])


_DATED = [{"partition_key": k, "partition_value": f"current_{k}"} for k in ("year", "month", "day")]

# The load configuration: tables, formats and date tokens.
LOAD_CONFIG = [
    {"table_name": "stars", "source": "raw/stars", "dest": "bronze", "format": "parquet", "partitions": _DATED},
    {"table_name": "objects", "source": "raw/objects", "dest": "bronze", "format": "parquet", "partitions": _DATED},
    {"table_name": "links", "source": "raw/links", "dest": "bronze", "format": "csv", "partitions": _DATED},
]
LOAD_TARGETS = {"stars": catalogs.STAR_BRONZE, "objects": catalogs.OBJECT_BRONZE}


def _load_bronze(spark: SparkSession, sf: str) -> dict[str, str]:
    """Raw files and a written configuration, loaded as it says."""
    root = scratch_path(spark, "lake")
    raw.write_extract(samples.stars(spark, sf).drop("year", "month", "day"), f"{root}/raw/stars")
    raw.write_extract(raw.object_extract(samples.centers(spark, sf), radius_deg=180.0), f"{root}/raw/objects")
    samples.bridge(spark, sf).write.csv(f"{root}/raw/links", header=True)
    spark.createDataFrame([(json.dumps(LOAD_CONFIG, indent=1),)], "text string").coalesce(1).write.text(f"{root}/config")
    loads = bronze.read_load_config(spark, f"{root}/config")
    return bronze.load_all(spark, root, loads, LOAD_TARGETS, LOAD_DATE)


def bronze_load(spark: SparkSession, sf: str) -> DataFrame:
    """Star extract to the 160-column bronze table and back."""
    path = _load_bronze(spark, sf)["stars"]
    columns = ["source_id", "ra", "dec", "parallax", "phot_bp_mean_mag", "vbroad", "j_m", "year", "month", "day"]
    schema = bronze.dated_schema(catalogs.STAR_BRONZE, ("year", "month", "day"))
    return _round(files.read_parquet(spark, path, columns, schema), 6)


def bronze_load_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the same configuration loads from CSV."""
    return files.read_parquet(spark, _load_bronze(spark, sf)["links"])


def medallion(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files through bronze, silver and gold tables; the fact table read back."""
    paths = _load_bronze(spark, sf)
    star_rows, object_rows = (
        files.read_parquet(spark, paths[name], schema=bronze.dated_schema(schema, ("year", "month", "day")))
        for name, schema in LOAD_TARGETS.items()
    )
    db = _database(spark)

    def save(df: DataFrame, name: str) -> DataFrame:
        silver.publish(df, f"{db}.{name}")
        return spark.table(f"{db}.{name}").drop(silver.TILE)

    astrometry = save(silver.astrometry_rows(star_rows), "astrometry")
    photometry = save(silver.photometry_rows(star_rows), "photometry")
    dimension = save(gold.object_dimension(save(silver.object_rows(object_rows), "objects")), "dim_objects")
    facts = save(gold.star_facts(astrometry, photometry, dimension), "facts")
    return _round(facts.select("source_id", "healpix_index", "bk_simbad", "distance_pc", "j_m"), 6)


def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """Planet records as JSON arrays with nulls read as zero values."""
    p = samples.planets(spark, sf)
    text = F.to_json(F.array(F.struct(*catalogs.PLANETS.names)), {"ignoreNullFields": "false"})
    parsed = jsonrecords.parse_records(p.select(text.alias("body")), "body", catalogs.PLANETS)
    return _round(parsed.drop(jsonrecords.CORRUPT))


def json_event_props(spark: SparkSession, sf: str) -> DataFrame:
    """``events.props`` as typed records; some texts are spoiled and kept as corrupt."""
    body = F.when(F.col("event_id") % 50 == 0, F.lit("[{broken")).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    df = samples.table(spark, sf, "events").select("event_id", body.alias("body"))
    return jsonrecords.parse_records(df, "body", catalogs.flat_schema("k bigint, missing string"), keep=("event_id",)).select(
        "event_id", "k", "missing", F.col(jsonrecords.CORRUPT).alias("corrupt")
    )


def json_reject_catalogs(spark: SparkSession, sf: str) -> DataFrame:
    """Records of users in groups; a group with a broken text is left out as a whole."""
    body = F.when(F.col("event_id") % 997 == 0, F.lit("[{broken")).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    df = samples.table(spark, sf, "events").select("event_id", (F.col("user_id") % 61).alias("catalog"), body.alias("body"))
    parsed = jsonrecords.parse_records(df, "body", catalogs.flat_schema("k bigint"), keep=("event_id", "catalog"))
    return jsonrecords.reject_catalogs_with_errors(parsed, "catalog").select("event_id", "catalog", "k")


def json_first_link(spark: SparkSession, sf: str) -> DataFrame:
    """Link lists wrapped around the page addresses; the first address comes back."""
    entry = F.struct(F.col("url").alias("url"))
    other = F.struct(F.concat("url", F.lit("?second")).alias("url"))
    links = F.when(F.col("page_id") % 10 != 0, F.array(entry, other)).otherwise(F.array().cast("array<struct<url:string>>"))
    body = F.to_json(F.struct(links.alias("strain")))
    return samples.table(spark, sf, "pages").select("page_id", jsonrecords.first_link(body).alias("url"))


def binary_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """One text file per benchmark item; length and hash of each file's bytes."""
    root = scratch_path(spark, "objects")
    samples.table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(root)
    found = files.file_inventory(spark, root)
    return found.select(F.regexp_extract("path", r"item_id=(\d+)", 1).cast("long").alias("item_id"), "length", "sha256")


def load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counts taken while ``documents`` is written, without a second pass over the data."""
    seen = observed(
        samples.table(spark, sf, "documents"),
        lambda rows: rows.write.parquet(scratch_path(spark, "observed")),
        {"n_bytes": F.sum(F.octet_length("text")), "n_english": F.count_if(F.col("lang") == "en")},
    )
    return spark.createDataFrame([seen], "n_records long, n_bytes long, n_english long")


# --- tables ---------------------------------------------------------------------------

SOME_TILES = 16  # order-2 tiles from this number on are loaded a second time


def _database(spark: SparkSession) -> str:
    name = f"starloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def _tiled_stars(spark: SparkSession, sf: str, columns: Sequence[str]) -> DataFrame:
    df = samples.stars(spark, sf).transform(with_healpix_index("ra", "dec"))
    return df.withColumn("sky_tile", parent_pixel(F.col("healpix_index"), 6, 2)).select(*columns, "healpix_index", "sky_tile")


def _create(spark: SparkSession, sf: str, columns: Sequence[str]) -> str:
    table = f"{_database(spark)}.stars"
    silver.publish(_tiled_stars(spark, sf, columns), table, ("sky_tile",), ("healpix_index", "source_id"))
    return table


def table_create_sync(spark: SparkSession, sf: str) -> DataFrame:
    table = _create(spark, sf, ["source_id", "ra", "dec"])
    return _round(spark.table(table))


def table_add_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A new column, a known one in other letters, and one that the new rows no longer have."""
    table = _create(spark, sf, ["source_id", "ra", "dec"])
    wider = _tiled_stars(spark, sf, ["source_id", "ra", "parallax"]).withColumnRenamed("ra", "RA")
    north = wider.filter(F.col("sky_tile") >= SOME_TILES)
    silver.publish(north, table, ("sky_tile",), ("healpix_index", "source_id"))
    return _round(spark.table(table).select("source_id", "ra", "dec", "parallax", "healpix_index", "sky_tile"))


def table_retyped(spark: SparkSession, sf: str) -> DataFrame:
    """New rows bring a fractional magnitude for an integer column: whole ones are written, the others are kept out."""
    whole = samples.table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 30).cast("int").alias("mag"), F.lit(1).alias("part"))
    table = f"{_database(spark)}.magnitudes"
    silver.publish(whole, table, ("part",), ("o_orderkey",))
    k = F.col("o_orderkey")
    again = whole.select(k, (F.col("mag") + F.when(k % 3 == 0, 0.7).otherwise(1.0)).alias("MAG"), F.lit(2).alias("part"))
    clean, lossy = shape.split_losses(tables.aligned(again, table, on_loss="mark"))
    silver.publish(clean, table, ("part",))
    kept_out = lossy.select("o_orderkey", F.lit(None).cast("int").alias("mag"), F.lit(0).alias("part"))
    return spark.table(table).unionByName(kept_out)


def overwrite_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of some tiles come again with other values; the other tiles stay."""
    table = _create(spark, sf, ["source_id", "ra", "dec"])
    again = _tiled_stars(spark, sf, ["source_id", "ra", "dec"]).withColumn("source_id", F.col("source_id") + 1000000)
    silver.publish(again.filter(F.col("sky_tile") >= SOME_TILES), table, ("sky_tile",))
    return _round(spark.table(table))


def purge_moved(spark: SparkSession, sf: str) -> DataFrame:
    """Stars that changed tile are entered under the new one and leave the old one."""
    table = _create(spark, sf, ["source_id", "ra", "dec"])
    moved = _tiled_stars(spark, sf, ["source_id", "ra", "dec"]).filter(F.col("sky_tile") >= SOME_TILES)
    moved = moved.withColumn("sky_tile", F.lit(999).cast("long"))
    silver.publish(moved, table, ("sky_tile",), purge_key="source_id")
    return _round(spark.table(table))


def clustered_write(spark: SparkSession, sf: str) -> DataFrame:
    """Rows clustered by tile and sorted by pixel, written and read back."""
    path = scratch_path(spark, "clustered")
    rows = _tiled_stars(spark, sf, ["source_id", "ra", "dec"])
    tables.clustered(rows, ["sky_tile"], ["healpix_index", "source_id"]).write.partitionBy("sky_tile").parquet(path)
    return _round(spark.read.parquet(path).withColumn("sky_tile", F.col("sky_tile").cast("long")))


# --- control table --------------------------------------------------------------------


def _control_log(spark: SparkSession, sf: str) -> DataFrame:
    """One job per customer, one log entry per order of that customer; some have no dates yet."""
    c = F.col("o_custkey")
    day = F.to_date("o_orderdate")
    return samples.table(spark, sf, "orders").select(
        F.concat(F.lit("job-"), c.cast("string")).alias("id"),
        F.concat(F.lit("pipeline_"), c.cast("string")).alias("pipeline"),
        F.when(c % 3 != 0, F.make_date(1990 + c % 5, F.lit(1), F.lit(15))).cast("date").alias("genesis"),
        F.when(c % 2 == 0, day).alias("current"),
        F.when(c % 2 == 0, "silver").otherwise("gold").alias("layer"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )


def _control_table(spark: SparkSession, sf: str) -> str:
    """A table made with its seed jobs, one per region, and the log of the customers' jobs appended."""
    table = f"{_database(spark)}.control"
    seeds = [(f"seed_{r[0]}", dt.date(1990, 1, 15), "bronze") for r in samples.table(spark, sf, "region").select("r_regionkey").collect()]
    control.create_control_table(spark, table, seeds)
    _control_log(spark, sf).write.mode("append").insertInto(table)
    return table


def control_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every job's date to start from: current, else first, else the fixed default; one job is asked for by name."""
    table = _control_table(spark, sf)
    state = control.current_state(spark.table(table))
    asked = control.lookup(spark, table, "bronze", "seed_1")
    named = control.find_job(state, "bronze", "seed_1").where(F.col("id") == asked["id"]).withColumn("layer", F.lit("asked"))
    return control.with_target_date(state.unionByName(named)).select("layer", "pipeline", "target_date")


def control_since(spark: SparkSession, sf: str) -> DataFrame:
    """Stars observed since the date that the control table gives for a seed job."""
    target = control.with_target_date(control.current_state(spark.table(_control_table(spark, sf))).where("pipeline = 'seed_1'"))
    rows = _two_observations(spark, sf).select("source_id", "fct_dt")
    later = F.date_format(F.add_months(F.to_date(F.lit(target.first()["target_date"])), 60), "yyyy-MM-dd")
    date = spark.range(1).select(later).first()[0]
    return control.since(rows, date)


def control_advance(spark: SparkSession, sf: str) -> DataFrame:
    """All silver jobs are moved on by entries appended to the log; one seed job and one new job by name."""
    log = _control_table(spark, sf)
    silver_jobs = control.current_state(spark.table(log)).filter("layer = 'silver'")
    stamp = F.to_timestamp(F.lit("2026-06-19 00:00:00"))
    control.advanced(stage(silver_jobs, "silver-jobs"), LOAD_DATE, stamp).write.mode("append").insertInto(log)
    control.advance(spark, log, "bronze", "seed_0", LOAD_DATE)
    control.advance(spark, log, "bronze", "new_job", LOAD_DATE)
    return control.current_state(spark.table(log)).select("pipeline", "genesis", "current", "layer")


# --- batches and landing --------------------------------------------------------------

EVENT = catalogs.flat_schema("event_id bigint, user_id bigint, props string")


def _event_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batch_records(samples.table(spark, sf, "events"), "event_type", ["event_id"], EVENT.names)


def batch_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _event_batches(spark, sf).select("catalog", "batch_no", "n_records", "hash")


def _spoiled(batches: DataFrame) -> DataFrame:
    """One line per batch that is no message."""
    return batches.select(F.concat(F.lit('{"catalog": "'), "catalog", F.lit('", cut off at '), F.col("hash")).alias("value"))


def _with_mirror(batches: DataFrame) -> DataFrame:
    """Messages of every batch and of a second catalogue with the same records, so with the same hash."""
    mirror = batches.withColumn("catalog", F.concat("catalog", F.lit("_mirror")))
    return as_messages(batches.unionByName(mirror))


def _land_events(spark: SparkSession, sf: str) -> str:
    """Every message twice and a spoiled line per batch, landed; then all of it once more."""
    source, root = scratch_path(spark, "messages"), scratch_path(spark, "landing")
    batches = stage(_event_batches(spark, sf), "event-batches")
    lines = _with_mirror(batches)
    lines.unionByName(lines).unionByName(_spoiled(batches)).write.text(source)
    landing.land_messages(spark, source, root, EVENT)
    lines.write.mode("append").text(source)
    landing.land_messages(spark, source, root, EVENT)
    return root


def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    return landing.landed_records(spark, _land_events(spark, sf), EVENT)


def stream_dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    return landing.dead_letters(spark, _land_events(spark, sf))


def stream_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats removed by stream state alone."""
    source, root = scratch_path(spark, "messages"), scratch_path(spark, "landing")
    lines = _with_mirror(stage(_event_batches(spark, sf), "event-batches"))
    lines.unionByName(lines).write.text(source)
    landing.land_within_watermark(spark, source, root, EVENT)
    return spark.read.parquet(f"{root}/landed").select("catalog", "hash", *EVENT.names)


def catalog_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Planet catalogue to messages to landed JSON rows; missing values are published as 0 and ""."""
    messages, root = scratch_path(spark, "messages"), scratch_path(spark, "landing")
    publishing.publish_catalog(samples.planets(spark, sf), messages)
    landed = publishing.land_catalog(spark, messages, root, record_format="json")
    return _round(landed.select("catalog", *catalogs.PLANETS.names))


QUERIES: dict[str, Query] = {
    "healpix_index": healpix_index,
    "unit_vectors": unit_vectors,
    "angular_distance": angular_distance,
    "distance_pc": distance_pc,
    "absolute_magnitude": absolute_magnitude,
    "propagate_motion": propagate_motion,
    "tangential_velocity": tangential_velocity,
    "quality_flags": quality_flags,
    "sexagesimal_to_deg": sexagesimal_to_deg,
    "date_key": date_keys,
    "keep_latest": keep_latest,
    "union_sources": union_sources,
    "nearest_rank": nearest_rank,
    "silver_astrometry": silver_astrometry,
    "silver_photometry": silver_photometry,
    "silver_clusters": silver_clusters,
    "dim_clusters": dim_clusters,
    "gold_fact": gold_fact,
    "gold_fact_bucketed": gold_fact_bucketed,
    "gold_fact_exact": gold_fact_exact,
    "raw_cluster_extract": raw_cluster_extract,
    "raw_individual_extract": raw_individual_extract,
    "join_astro_photo": join_astro_photo,
    "join_pixel_left": join_pixel_left,
    "pixel_candidates": pixel_candidates,
    "left_join_chain": left_join_chain,
    "cone_search": cone_search,
    "cone_search_tiles": cone_search_tiles,
    "cone_count": cone_count,
    "density_radius": density_radius,
    "density_extract": density_extract,
    "valid_coords": valid_coords,
    "sky_pairs_within": sky_pairs_within,
    "conform_schema": conform_schema,
    "schema_check": schema_check,
    "catalog_projection": catalog_projection,
    "serve_ids": serve_ids,
    "csv_infer": csv_infer,
    "scan_recursive": scan_recursive,
    "scan_merge_schema": scan_merge_schema,
    "conform_files": conform_files,
    "bronze_load": bronze_load,
    "bronze_load_csv": bronze_load_csv,
    "medallion": medallion,
    "json_records": json_records,
    "json_event_props": json_event_props,
    "json_reject_catalogs": json_reject_catalogs,
    "json_first_link": json_first_link,
    "binary_inventory": binary_inventory,
    "load_metrics": load_metrics,
    "table_create_sync": table_create_sync,
    "table_add_columns": table_add_columns,
    "table_retyped": table_retyped,
    "overwrite_partitions": overwrite_partitions,
    "purge_moved": purge_moved,
    "clustered_write": clustered_write,
    "control_lookup": control_lookup,
    "control_since": control_since,
    "control_advance": control_advance,
    "batch_hash": batch_hash,
    "stream_landing": stream_landing,
    "stream_dead_letter": stream_dead_letter,
    "stream_watermark": stream_watermark,
    "catalog_landing": catalog_landing,
}
