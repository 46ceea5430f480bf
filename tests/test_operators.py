from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from starloom.functions.healpix import with_healpix_index
from starloom.operators import joins, ranking, shape
from starloom.operators.batches import as_messages, batch_records
from starloom.plans import gold, silver
from starloom.sources import tables
from starloom.sources.catalogs import ASTROMETRY, STAR_BRONZE, flat_schema

from .conftest import plan_of


def test_keep_latest_is_fixed_and_idempotent(spark):
    rows = [(1, "20260101", 2.0), (1, "20260103", 5.0), (1, "20260103", 4.0), (2, "20250101", None), (2, "20250101", 1.0)]
    df = spark.createDataFrame(rows, "source_id long, fct_dt string, v double")
    once = ranking.keep_latest(df)
    assert sorted(map(tuple, once.collect())) == [(1, "20260103", 4.0), (2, "20250101", None)]
    assert sorted(map(tuple, ranking.keep_latest(once).collect())) == sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, ranking.keep_latest(df.repartition(7, "v")).collect())) == sorted(map(tuple, once.collect()))


def test_ranking_reduces_before_the_shuffle(spark, tmp_path):
    """The limit below the exchange is what keeps a hot key from gathering in one task."""
    spark.range(100).selectExpr("id % 3 AS source_id", "cast(id AS string) AS fct_dt").write.parquet(str(tmp_path / "t"))
    plan = plan_of(ranking.keep_latest(spark.read.parquet(str(tmp_path / "t"))))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_nearest_by(spark):
    rows = [(1, 0.2, "b"), (1, 0.2, "a"), (1, None, "z"), (2, None, None), (3, float("nan"), "n"), (3, 9.0, "m")]
    df = spark.createDataFrame(rows, "source_id long, d double, bk string")
    assert sorted((r.source_id, r.bk) for r in ranking.nearest_by(df, "source_id", "d", "bk").collect()) == [(1, "a"), (2, None), (3, "m")]


def test_assert_schema(spark):
    ok = spark.createDataFrame([], "source_id bigint, ra double, dec double, parallax float, parallax_error double, pmra double, pmdec double, ruwe double, fct_dt string, healpix_index bigint, more int")
    assert shape.assert_schema(ok, ASTROMETRY) is ok
    with pytest.raises(shape.SchemaError, match="ruwe: missing"):
        shape.assert_schema(ok.drop("ruwe"), ASTROMETRY)
    with pytest.raises(shape.SchemaError, match="fct_dt"):
        shape.assert_schema(ok.withColumn("fct_dt", F.lit(1)), ASTROMETRY)


def conform_one(spark, value, have, want, on_loss="mark"):
    df = spark.createDataFrame([(value,)], f"c {have}")
    return shape.conform(df, flat_schema(f"c {want}"), on_loss).first()


@pytest.mark.parametrize(
    "value,have,want,result,lost",
    [
        (1.0, "double", "bigint", 1, False),
        (1.7, "double", "bigint", None, True),
        (float("nan"), "double", "bigint", None, True),
        (None, "double", "bigint", None, False),
        (1e300, "double", "bigint", None, True),
        (2**40, "bigint", "int", None, True),
        (7, "int", "double", 7.0, False),
        (2**53 + 1, "bigint", "double", None, True),
        (0.1, "double", "float", pytest.approx(0.1), False),
        ("x", "string", "bigint", None, True),
        ("12", "string", "bigint", 12, False),
        ("1.5", "string", "double", 1.5, False),
        (12, "int", "string", "12", False),
        (True, "boolean", "bigint", 1, False),
    ],
)
def test_conform_casts(spark, value, have, want, result, lost):
    row = conform_one(spark, value, have, want)
    assert row.c == result and row[shape.CAST_ERRORS] == (["c"] if lost else [])


def test_conform_columns_and_failure(spark):
    target = flat_schema("a bigint, b string, c float")
    df = spark.createDataFrame([(1, 2.0, "surplus")], "c int, a double, z string")
    once = shape.conform(df, target)
    assert once.schema.simpleString() == "struct<a:bigint,b:string,c:float>"
    assert tuple(once.first()) == (2, None, 1.0)
    assert shape.conform(once, target).collect() == once.collect()
    with pytest.raises(Exception, match="column a"):
        shape.conform(spark.createDataFrame([(1.7,)], "a double"), target).collect()
    clean, lossy = shape.split_losses(shape.conform(spark.createDataFrame([(1.7,), (2.0,)], "a double"), target, "mark"))
    assert clean.count() == 1 and lossy.count() == 1
    with pytest.raises(ValueError):
        shape.conform(df, target, "ignore")


def test_conform_to_the_bronze_schema(spark):
    df = spark.createDataFrame([(5, 1.25, 3)], "source_id int, ra float, phot_bp_mean_mag int")
    out = shape.conform(df, STAR_BRONZE)
    assert len(out.columns) == 160 and out.schema == STAR_BRONZE
    assert (out.first().source_id, out.first().ra, out.first().phot_bp_mean_mag) == (5, 1.25, "3")


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(2, 1), (2, 1)], "y int, x int")
    assert sorted(map(tuple, shape.union_all_by_name([a, b]).collect())) == [(1, 2)] * 3
    assert shape.union_all_by_name([a, b.drop("y")], fill_missing=True).filter("y is null").count() == 2


def test_left_join_fan_out_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (9, 90), (None, 0)], "k int, w int")
    want = sorted(map(str, left.join(right, "k", "left").collect()))
    for hot_rows in (1, 1000):  # with and without hot keys
        assert sorted(map(str, joins.left_join_fan_out(left, right, "k", hot_rows).collect())) == want


def test_counterpart_chain_keeps_every_star(spark):
    stars = spark.range(5).withColumnRenamed("id", "source_id")
    neighbours = spark.createDataFrame([(0, 100, 0.5), (0, 101, 0.7), (1, 102, 0.1), (2, 999, 0.2)], "source_id long, clean_tmass_psc_xsc_oid long, angular_distance double")
    bridge = spark.createDataFrame([(100, "A"), (101, "B"), (102, "C")], "clean_tmass_psc_xsc_oid long, original_psc_source_id string")
    infrared = spark.createDataFrame([("A", 1.0, 2.0, 3.0), ("C", 4.0, 5.0, 6.0)], "designation string, j_m float, h_m float, ks_m float")
    got = sorted((r.source_id, r.angular_distance_arcsec or 0.0, r.j_m or 0.0) for r in joins.counterpart_chain(stars, neighbours, bridge, infrared).collect())
    assert got == [(0, 0.5, 1.0), (0, 0.7, 0.0), (1, 0.1, 4.0), (2, 0.2, 0.0), (3, 0.0, 0.0), (4, 0.0, 0.0)]


def test_pixel_candidates(spark):
    stars = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "source_id long, healpix_index long")
    objects = spark.createDataFrame([("b", 5), ("a", 5), ("c", 7)], "bk_simbad string, healpix_index long")
    got = {r.source_id: (r.candidates, r.first_bk, r.last_bk) for r in joins.pixel_candidates(stars, objects).collect()}
    assert got == {1: (2, "a", "b"), 2: (0, None, None), 3: (0, None, None)}


def expected_batches(rows, size):
    out = {}
    for catalog in sorted({r[0] for r in rows}):
        mine = sorted(r[1:] for r in rows if r[0] == catalog)
        for start in range(0, len(mine), size):
            text = json.dumps([{"n": n, "s": s} for n, s in mine[start : start + size]], separators=(",", ":"))
            out[catalog, start // size] = (len(mine[start : start + size]), hashlib.sha256(text.encode()).hexdigest())
    return out


def test_batches_do_not_depend_on_the_split(spark):
    rows = [("big", i, f"v{i % 7}") for i in range(2001)] + [("small", i, "x") for i in range(3)]
    df = spark.createDataFrame(rows, "c string, n long, s string")
    want = expected_batches(rows, 1000)
    assert sorted(v[0] for v in want.values()) == [1, 3, 1000, 1000]
    for split in (df.coalesce(1), df.repartition(13), df.repartition(3, "s")):
        got = {(r.catalog, r.batch_no): (r.n_records, r.hash) for r in batch_records(split, "c", ["n"], ["n", "s"]).collect()}
        assert got == want


def test_batches_with_copies_of_one_record(spark):
    rows = [("a", 1, "same")] * 2500 + [("a", 0, "first"), ("b", 2, None)]
    df = spark.createDataFrame(rows, "c string, n long, s string").repartition(8)
    got = batch_records(df, "c", ["n"], ["n", "s"]).collect()
    assert sorted((r.catalog, r.n_records) for r in got) == [("a", 501), ("a", 1000), ("a", 1000), ("b", 1)]
    assert next(r.data for r in got if r.catalog == "b") == '[{"n":2,"s":null}]'


def test_messages_are_json(spark):
    df = spark.createDataFrame([('quo"te', 1, "x")], "c string, n long, s string")
    message = json.loads(as_messages(batch_records(df, "c", ["n"], ["n", "s"])).first().value)
    assert message["catalog"] == 'quo"te' and message["data"] == [{"n": 1, "s": "x"}]
    assert message["hash"] == hashlib.sha256(b'[{"n":1,"s":"x"}]').hexdigest()


STAR = "source_id long, ra double, dec double, parallax double, parallax_error double, pmra double, pmdec double, ruwe double, j_m float, h_m float, ks_m float, year int, month int, day int"


def star(i, ra, dec, day=1, plx=10.0, err=0.5):
    return (i, ra, dec, plx, err, 1.0, 1.0, 1.0, 10.0, 9.5, 9.25, 2026, 1, day)


def test_silver_and_gold_on_a_small_sky(spark):
    stars = spark.createDataFrame([star(1, 10.0, 20.0), star(1, 10.0, 20.0, 3, plx=5.0), star(2, 50.0, -30.0, plx=0.0), star(None, 1.0, 1.0)], STAR)
    astrometry, photometry = silver.astrometry_rows(stars), silver.photometry_rows(stars)
    kept = {r.source_id: r for r in astrometry.collect()}
    assert set(kept) == {1, 2} and kept[1].fct_dt == "20260103" and kept[1].parallax == 5.0
    assert kept[1].is_reliable_plx and not kept[2].is_reliable_plx
    raw = spark.createDataFrame([(" M 45 ", 10.0, 20.0, 2026, 1, 1), ("M 45", 10.0, 20.0, 2025, 1, 1), ("far", 10.1, 20.0, 2026, 1, 1)], "main_id string, ra_deg double, dec_deg double, year int, month int, day int")
    dimension = gold.object_dimension(silver.object_rows(raw))
    assert {r.main_id for r in dimension.collect()} == {"M 45", "far"}
    facts = {r.source_id: r for r in gold.star_facts(astrometry, photometry, dimension).collect()}
    assert facts[1].bk_simbad == hashlib.md5(b"M 45|10.0|20.0").hexdigest() and facts[2].bk_simbad == "-1"
    assert facts[1].distance_pc == 200.0 and facts[2].distance_pc == 0.0 and facts[2].abs_mag_j == float("inf")
    assert facts[1].color_j_h == 0.5 and facts[1].color_h_ks == 0.25


def test_gold_needs_no_shuffle_beyond_its_inputs(spark, tmp_path):
    """With a small dimension the join on source_id is the only exchange of star rows."""
    stars = spark.createDataFrame([star(i, 10.0 + i, 20.0) for i in range(20)], STAR)
    silver.astrometry_rows(stars, latest=False).write.parquet(str(tmp_path / "a"))
    silver.photometry_rows(stars, latest=False).write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([("k", 10.0, 20.0, 1)], "bk_simbad string, ra double, dec double, healpix_index long").write.parquet(str(tmp_path / "d"))
    a, p, d = (spark.read.parquet(str(tmp_path / x)) for x in "apd")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = plan_of(gold.star_facts(a, p, d))
    assert plan.count("Exchange hashpartitioning(source_id") <= 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = gold.star_facts(a, p, d)
        assert "NestedLoop" not in plan_of(large) and "Cartesian" not in plan_of(large)
        assert large.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_gold_from_bucketed_tables_moves_no_wide_row(spark):
    """Published by source id, the silver tables meet each other and the matches without an exchange or a sort of their own."""
    stars = spark.createDataFrame([star(i, 10.0 + i / 7, 20.0) for i in range(300)], STAR)
    for name, rows in (("a", silver.astrometry_rows(stars)), ("p", silver.photometry_rows(stars))):
        tables.publish_by_key(rows, f"bucketed_{name}", "source_id", 4)
        tables.publish_by_key(rows, f"bucketed_{name}", "source_id", 4)  # replaces the first
    objects = spark.createDataFrame([(f"k{i}", 10.0 + i / 7, 20.0, 1) for i in range(0, 300, 3)], "bk_simbad string, ra double, dec double, healpix_index long")
    objects = objects.transform(with_healpix_index("ra", "dec"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = gold.star_facts(spark.table("bucketed_a"), spark.table("bucketed_p"), objects, staged=False)
        lines = plan_of(facts).splitlines()
        wide = [line for i, line in enumerate(lines) if "Exchange hashpartitioning(source_id" in line and "threshold_angular_d" not in "".join(lines[i + 1 : i + 3])]
        assert not wide
        plain = gold.star_facts(silver.astrometry_rows(stars), silver.photometry_rows(stars), objects)
        assert facts.exceptAll(plain).count() == 0 and facts.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in "ap":
            spark.sql(f"DROP TABLE bucketed_{name}")
