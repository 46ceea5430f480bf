from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import sky
from starloom.functions.healpix import with_healpix_index
from starloom.functions.keys import NO_MATCH, business_key, clip, date_key, match_or_sentinel, target_date

NAN = float("nan")


def evaluate(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_healpix_known_faces(spark):
    rows = [(0.0, 0.0), (90.0, 0.0), (45.0, 45.0), (45.0, -45.0), (180.0, 0.0), (270.0, 0.0), (315.0, 80.0), (315.0, -80.0)]
    df = spark.createDataFrame(rows, "ra double, dec double").transform(with_healpix_index("ra", "dec", 0))
    assert [r.healpix_index for r in df.collect()] == [4, 5, 0, 8, 6, 7, 3, 11]


def test_healpix_edges(spark):
    rows = [(None, 1.0), (1.0, None), (NAN, 1.0), (1.0, NAN), (1.0, 90.5), (1.0, -91.0), (0.0, 90.0), (0.0, -90.0), (-1e-18, 0.0), (360.0, 0.0)]
    df = spark.createDataFrame(rows, "ra double, dec double").transform(with_healpix_index("ra", "dec"))
    got = [r.healpix_index for r in df.collect()]
    assert got[:6] == [None] * 6
    # poles lie in the outermost pixel of a polar face
    assert got[6] == 4095 and got[7] == 8 * 4096
    zero = spark.createDataFrame([(0.0, 0.0)], "ra double, dec double").transform(with_healpix_index("ra", "dec")).first()
    assert got[9] == zero.healpix_index
    assert 0 <= got[8] < 12 * 4096


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(0, 360, exclude_max=True), st.floats(-90, 90)), min_size=50, max_size=200))
def test_healpix_nests_and_stays_in_range(spark, points):
    df = spark.createDataFrame(points, "ra double, dec double")
    for depth in (3, 6, 13):
        df = df.transform(with_healpix_index("ra", "dec", depth, f"p{depth}"))
    for r in df.collect():
        assert 0 <= r.p3 < 12 * 4**3 and 0 <= r.p6 < 12 * 4**6 and 0 <= r.p13 < 12 * 4**13
        assert r.p6 >> 6 == r.p3 and r.p13 >> 14 == r.p6


def test_healpix_pixels_have_equal_areas(spark):
    n = 200_000
    # an even spiral over the sphere
    df = spark.range(n).selectExpr(
        f"degrees(asin(2D * (id + 0.5D) / {n} - 1D)) AS dec", "pmod(id * 137.50776405003785D, 360D) AS ra"
    )
    counts = df.transform(with_healpix_index("ra", "dec", 2)).groupBy("healpix_index").count().collect()
    assert len(counts) == 192
    assert all(abs(r["count"] * 192 / n - 1) < 0.05 for r in counts)


def test_healpix_rejects_bad_depth():
    with pytest.raises(ValueError):
        with_healpix_index("ra", "dec", 30)


def test_unit_vectors_have_length_one(spark):
    df = spark.range(500).selectExpr("id * 0.72D AS ra", "id * 0.36D - 90D AS dec").transform(sky.with_unit_vectors("ra", "dec"))
    for r in df.collect():
        assert math.isclose(r.x_unit**2 + r.y_unit**2 + r.z_unit**2, 1.0, rel_tol=1e-12)
        assert math.isclose(r.z_unit, math.sin(math.radians(r.dec)), abs_tol=1e-12)


def test_separation_wrap_and_poles(spark):
    rows = [(359.9999, 10.0, 0.0001, 10.0), (12.0, 90.0, 200.0, 90.0), (12.0, -90.0, 50.0, -90.0), (0.0, 0.0, 180.0, 0.0)]
    got = evaluate(
        spark, rows, "a double, b double, c double, d double",
        sky.flat_separation("a", "b", "c", "d"), sky.great_circle_separation("a", "b", "c", "d"),
    )
    assert math.isclose(got[0][0], 359.9998 * math.cos(math.radians(10)), rel_tol=1e-9)
    assert math.isclose(got[0][1], 0.0002 * math.cos(math.radians(10)), rel_tol=1e-6)
    assert got[1][1] < 1e-9 and got[2][1] < 1e-9
    assert math.isclose(got[3][1], 180.0)


def test_parallax_rules(spark):
    rows = [(0.0, 0.1), (None, 0.1), (NAN, 0.1), (-2.0, 0.1), (5.0, 0.5), (5.0, None), (5.0, 1.0)]
    reliable = sky.reliable_parallax("p", "e")
    got = evaluate(spark, rows, "p double, e double", reliable, sky.distance_parsec("p", reliable))
    assert [g[0] for g in got] == [False, None, False, False, True, None, False]
    assert [g[1] for g in got] == [0.0, 0.0, 0.0, 0.0, 200.0, 0.0, 0.0]


def test_ruwe_limit(spark):
    rows = [(1.3999,), (1.4,), (NAN,), (None,)]
    assert [g[0] for g in evaluate(spark, rows, "ruwe double", sky.reliable_astrometry("ruwe"))] == [True, False, False, None]


def test_absolute_magnitude_at_distance_zero(spark):
    rows = [(10.0, 0.0), (None, 0.0), (10.0, 100.0), (10.0, None)]
    got = evaluate(
        spark, rows, "m float, d double", sky.absolute_magnitude("m", "d"), sky.absolute_magnitude("m", "d", True)
    )
    assert got == [(math.inf, None), (None, None), (5.0, 5.0), (None, None)]


def test_propagation(spark):
    rows = [(10.0, 60.0, 3600.0, -3600.0), (10.0, 60.0, None, None), (10.0, 0.0, 0.0, 0.0)]
    got = evaluate(spark, rows, "ra double, dec double, a double, b double", *sky.propagate("ra", "dec", "a", "b"))
    assert math.isclose(got[0][0], 10.0 + 0.016 / math.cos(math.radians(60))) and math.isclose(got[0][1], 59.984)
    assert got[1] == (10.0, 60.0) and got[2] == (10.0, 0.0)


def test_tangential_velocity_forms(spark):
    got = evaluate(
        spark, [(1000.0, 3.0, 4.0), (1000.0, None, 4.0)], "d double, a double, b double",
        sky.tangential_velocity("d", "a", "b"), sky.tangential_velocity("d", "a", "b", corrected=True),
    )
    assert math.isclose(got[0][0], 4.74 * 1000 * 3 + 16) and math.isclose(got[0][1], 4.74 * 5)
    assert got[1] == (None, None)


def test_sexagesimal(spark):
    texts = ["02h07m10.40s", "+23d27m44.7s", "-00d30m00s", "-23:27:44.7", "10 30 00", "rubbish", "", None]
    got = [g[0] for g in evaluate(spark, [(t,) for t in texts], "t string", sky.sexagesimal_to_degrees("t"))]
    want = [31.793333333, 23.462416667, -0.5, -23.462416667, 10.5, None, None, None]
    assert all(a == b or math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, want))
    hours = evaluate(spark, [("10 30 00",)], "t string", sky.sexagesimal_to_degrees("t", hours=True))
    assert math.isclose(hours[0][0], 157.5)


def test_date_key_is_unambiguous(spark):
    rows = [(2026, 1, 12), (2026, 11, 2)]
    assert [g[0] for g in evaluate(spark, rows, "y int, m int, d int", date_key("y", "m", "d"))] == ["20260112", "20261102"]


def test_keys_and_defaults(spark):
    rows = [("C1", 10.5, 1 / 3600, "2026-01-02", None), ("C2", 0.25, 1.01 / 3600, None, "2025-05-05"), ("C3", None, None, None, None)]
    got = evaluate(
        spark, rows, "n string, v double, s double, cur string, gen string",
        match_or_sentinel("n", "s", 1 / 3600), target_date("cur", "gen"), clip("v", 0.5, 2.0), business_key("n", "v"),
    )
    assert [g[0] for g in got] == ["C1", NO_MATCH, NO_MATCH]
    assert [g[1] for g in got] == ["2026-01-02", "2025-05-05", "2026-06-19"]
    assert [g[2] for g in got][:2] == [2.0, 0.5]
    import hashlib

    assert got[0][3] == hashlib.md5(b"C1|10.5").hexdigest()


def test_target_date_takes_dates_and_timestamps(spark):
    df = spark.sql("SELECT DATE '2026-04-02' AS d, TIMESTAMP '2026-04-03 10:00:00' AS t")
    assert tuple(df.select(target_date(F.lit(None), "d"), target_date("t", "d")).first()) == ("2026-04-02", "2026-04-03")
