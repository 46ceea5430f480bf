from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import healpix
from starloom.functions.healpix import with_healpix_index
from starloom.functions.sky import ARCSEC, chord
from starloom.operators import discs, spatial

from .conftest import plan_of


def unit(ra, dec):
    a, d = math.radians(ra), math.radians(dec)
    return math.cos(a) * math.cos(d), math.sin(a) * math.cos(d), math.sin(d)


def separation(a, b):
    return math.degrees(2 * math.asin(min(1.0, math.dist(unit(*a), unit(*b)) / 2)))


def sphere_points(n, seed):
    r = random.Random(seed)
    points = [(r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1)))) for _ in range(n)]
    return points + [(0.0, 89.9), (120.0, 89.9), (240.0, 89.9), (0.01, 0.0), (359.99, 0.0), (7.0, -90.0), (99.0, -89.95)]


def frame(spark, points, prefix="", key="id"):
    rows = [(i, ra, dec) for i, (ra, dec) in enumerate(points)]
    return spark.createDataFrame(rows, f"{key} long, ra{prefix} double, dec{prefix} double")


@pytest.mark.parametrize("radius,factor", [(1.0, 1.0), (3.0, 1.0), (3.0, 4.0), (20.0, 1.0)])
def test_pairs_equal_brute_force(spark, radius, factor):
    a, b = sphere_points(400, 1), sphere_points(150, 2)
    left, right = frame(spark, a), frame(spark, b, "_r", "other")
    got = [(r.id, r.other) for r in spatial.pairs_within(left, right, radius, cell_factor=factor).collect()]
    want = [(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if separation(p, q) <= radius]
    assert sorted(got) == sorted(want) and len(set(got)) == len(got) and want


def test_pairs_are_found_by_an_equi_join(spark):
    pairs = spatial.pairs_within(frame(spark, sphere_points(10, 1)), frame(spark, sphere_points(5, 2), "_r", "o"))
    plan = plan_of(pairs)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_exploded_side_is_not_broadcast_by_a_low_estimate(spark, tmp_path):
    """The file is below the threshold, its copies in cells are above it."""
    frame(spark, sphere_points(20_000, 1)).write.parquet(str(tmp_path / "l"))
    frame(spark, sphere_points(2000, 2), "_r", "other").write.parquet(str(tmp_path / "r"))
    left, right = (spark.read.parquet(str(tmp_path / x)) for x in "lr")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(200 * 1024))
        assert "BroadcastHashJoin" in plan_of(left.join(right, left.id == right.other))
        assert "BroadcastHashJoin" not in plan_of(spatial.pairs_within(left, right, 1.0))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(50 * 1024 * 1024))
        assert "BroadcastHashJoin" in plan_of(spatial.pairs_within(left, right, 1.0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("center,radius", [((31.8, 23.5), 10.0), ((0.0, 0.0), 5.0), ((200.0, 88.0), 6.0)])
def test_cone(spark, center, radius):
    points = sphere_points(3000, 3)
    got = {r.id for r in frame(spark, points).transform(spatial.cone_search(*center, radius)).collect()}
    assert got == {i for i, p in enumerate(points) if separation(p, center) <= radius}


def test_cone_prefilter_reaches_parquet(spark, tmp_path):
    frame(spark, sphere_points(100, 3)).write.parquet(str(tmp_path / "p"))
    plan = plan_of(spark.read.parquet(str(tmp_path / "p")).transform(spatial.cone_search(10.0, 20.0, 1.0)))
    assert "GreaterThanOrEqual(dec" in plan and "LessThanOrEqual(dec" in plan


@pytest.mark.parametrize("per_pixel", [0.05, 4.0, 1000.0])
def test_counts_equal_brute_force(spark, per_pixel):
    points, around = sphere_points(3000, 4), sphere_points(60, 5) + [(0.0, 90.0), (120.0, -90.0), (0.0, 0.0), (45.0, 41.8103)]
    points += [points[0]] * 50  # copies of one position
    got = spatial.count_in_cones(frame(spark, points), frame(spark, around), 8.0, per_pixel=per_pixel).collect()
    assert len(got) == len(around)
    for r in got:
        assert r.n_obs == sum(separation(p, (r.ra, r.dec)) <= 8.0 for p in points)


def test_counts_with_own_radii(spark):
    points, r = sphere_points(2000, 6), random.Random(6)
    centers = [(i, *p, radius) for i, (p, radius) in enumerate(zip(sphere_points(40, 7), [0.001, 1.0, 7.5, 60.0, 120.0, 180.0, None, -1.0] * 6))]
    frame_ = spark.createDataFrame([*centers, (99, None, 1.0, 5.0)], "id int, ra double, dec double, radius double")
    got = {x.id: x.n_obs for x in spatial.count_in_cones(frame(spark, points), frame_, "radius").collect()}
    assert got.pop(99) == 0
    assert got == {i: sum(separation(p, (ra, dec)) <= radius for p in points) if radius and radius > 0 else 0 for i, ra, dec, radius in centers}
    assert spatial.count_in_cones(frame(spark, points).limit(0), frame_, 1.0).agg(F.sum("n_obs")).first()[0] == 0


def test_few_rim_points_however_dense(spark):
    """Sixteen times the density: points met one by one grow less, about with its square root."""
    met = []
    for n in (4_000, 64_000):
        points = frame(spark, sphere_points(n, 8))
        discs_ = discs.with_vector(frame(spark, sphere_points(20, 9)), ("ra", "dec")).withColumn("__reach", F.lit(chord(10.0)))
        cover = discs.disc_cover(discs.with_local_stop(discs_, points, ("ra", "dec"), ("ra", "dec")), whole=True).where("NOT whole")
        rim = discs.at_orders(points.select("ra", "dec"), discs.orders_of(cover), ("ra", "dec")).join(cover.drop("ra", "dec"), ["pixel_order", "pixel"])
        met.append(rim.count())
    assert met[0] < 27 * 60 and met[1] < 10 * met[0]


def test_pairs_with_own_radii(spark):
    points = sphere_points(1500, 10)
    centers = [(i, *p, radius) for i, (p, radius) in enumerate(zip(sphere_points(35, 11), [0.01, 0.1, 0.9, 2.0, 20.0, None, float("nan")] * 5))]
    right = spark.createDataFrame(centers, "c int, ra_r double, dec_r double, radius_deg double")
    got = {(r.id, r.c) for r in spatial.pairs_in_cones(frame(spark, points), right).collect()}
    assert got == {(i, c) for i, p in enumerate(points) for c, ra, dec, radius in centers if radius and separation(p, (ra, dec)) <= radius}
    assert spatial.pairs_in_cones(frame(spark, points), right.limit(0)).count() == 0


def test_density_radius(spark):
    counted = spark.createDataFrame([("a", 10), ("b", 10**9), ("c", 1000)], "k string, n_obs long")
    got = {r.k: r.radius_deg for r in spatial.density_radius(counted).collect()}
    assert got["a"] == 2.0 and got["b"] == 0.1
    assert math.isclose(got["c"], math.sqrt(250000 / (1000 / (math.pi * 0.01)) / math.pi))
    empty = spark.createDataFrame([("d", 0)], "k string, n_obs long")
    assert spatial.density_radius(empty, on_empty="null").first().radius_deg is None
    with pytest.raises(Exception, match="no sources"):
        spatial.density_radius(empty).collect()


def test_valid_coordinates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, float("nan"))], "ra double, dec double")
    assert df.transform(spatial.valid_coordinates()).count() == 1


def flat(ra_l, dec_l, ra_r, dec_r):
    return math.hypot((ra_l - ra_r) * math.cos(math.radians(dec_l)), dec_l - dec_r)


STEP = 16.0 / 3.6e6


def stars_and_objects(seed):
    """Stars with very different motions, objects placed where some of them match."""
    r = random.Random(seed)
    stars, objects = [], []
    for i in range(500):
        near_pole = i % 25 == 0
        dec = r.choice([-1, 1]) * (90 - r.uniform(0, 0.004)) if near_pole else math.degrees(math.asin(r.uniform(-1, 1)))
        ra = r.uniform(0, 360) if i % 7 else r.choice([0.0001, 359.9999])
        scale = r.choice([0, 5, 100, 10_000, 1e7])
        pmra = None if i % 11 == 0 else r.uniform(-scale, scale)
        pmdec = None if i % 13 == 0 else r.uniform(-scale, scale)
        stars.append((i, ra, dec, pmra, pmdec))
        # an object that this star's motion carries to about one tolerance from the star
        off_ra, off_dec = r.uniform(-1.2, 1.2) * ARCSEC, r.uniform(-1.2, 1.2) * ARCSEC
        obj_dec = dec + off_dec - (pmdec or 0) * STEP
        if abs(obj_dec) < 90:
            obj_ra = ra + off_ra - (pmra or 0) * STEP / math.cos(math.radians(obj_dec))
            objects.append((f"k{i:04d}", obj_ra % 360, obj_dec))
            if i % 10 == 0:
                objects.append((f"j{i:04d}", obj_ra % 360, obj_dec))  # a tie at one position
    stars += [(1000, None, 3.0, 1.0, 1.0), (1001, 3.0, None, 1.0, 1.0), (1002, float("nan"), 1.0, 0.0, 0.0), (1003, 5.0, 5.0, float("nan"), 0.0)]
    return stars, objects


def best_match(star, objects, pixels_s, pixels_o, mode):
    i, ra, dec, pmra, pmdec = star
    found = []
    if ra is None or dec is None or math.isnan(ra):
        return "-1"
    for n, (key, ra_r, dec_r) in enumerate(objects):
        ra_p = ra_r + (pmra or 0) * STEP / math.cos(math.radians(dec_r))
        dec_p = dec_r + (pmdec or 0) * STEP
        if mode == "pixel":
            if pixels_s[i] != pixels_o[n]:
                continue
            d = flat(ra, dec, ra_p, dec_p)
        else:
            d = separation((ra, dec), (ra_p, dec_p)) if not math.isnan(ra_p) else math.inf
        if d <= ARCSEC:
            found.append((d, key))
    if not found:
        return "-1"
    least = min(d for d, _ in found)
    return min(k for d, k in found if d <= least + 1e-12)


@pytest.mark.parametrize("mode", ["pixel", "exact"])
@pytest.mark.parametrize("seed", [11, 12])
def test_counterparts_equal_brute_force(spark, mode, seed):
    stars, objects = stars_and_objects(seed)
    s = spark.createDataFrame(stars, "source_id long, ra double, dec double, pmra double, pmdec double")
    o = spark.createDataFrame(objects, "bk_simbad string, ra double, dec double")
    s, o = (d.transform(with_healpix_index("ra", "dec")) for d in (s, o))
    pixels_s = {r.source_id: r.healpix_index for r in s.collect()}
    by_key = {r.bk_simbad: r.healpix_index for r in o.collect()}
    pixels_o = [by_key[k] for k, _, _ in objects]
    matched = spatial.nearest_counterpart(spatial.attach_counterparts(s, o, mode=mode))
    got = {r.source_id: r.bk_simbad for r in matched.collect()}
    assert len(got) == len(stars) and matched.count() == len(stars)
    want = {st[0]: best_match(st, objects, pixels_s, pixels_o, mode) for st in stars}
    wrong = {k: (got[k], want[k]) for k in want if got[k] != want[k]}
    assert not wrong
    assert sum(v != "-1" for v in want.values()) > 100


def test_pixel_edge_is_lost_in_pixel_mode_only(spark):
    # 0.2″ apart on both sides of the meridian at ra = 90
    s = spark.createDataFrame([(1, 90.0 - 0.1 * ARCSEC, 0.3, 0.0, 0.0)], "source_id long, ra double, dec double, pmra double, pmdec double")
    o = spark.createDataFrame([("k", 90.0 + 0.1 * ARCSEC, 0.3)], "bk_simbad string, ra double, dec double")
    s, o = (d.transform(with_healpix_index("ra", "dec", 1)) for d in (s, o))
    pixel = {m: spatial.nearest_counterpart(spatial.attach_counterparts(s, o, mode=m)).first().bk_simbad for m in ("pixel", "exact")}
    if s.first().healpix_index != o.first().healpix_index:
        assert pixel == {"pixel": "-1", "exact": "k"}
    else:
        assert pixel == {"pixel": "k", "exact": "k"}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        spatial.attach_counterparts(spark.range(1), spark.range(1), mode="other")


def test_all_stars_in_one_place(spark):
    """A third of all rows at one position: still one row per star and no lost match."""
    n = 3000
    s = spark.range(n).selectExpr(
        "id AS source_id", "IF(id % 3 = 0, 10D, id / 100D) AS ra", "IF(id % 3 = 0, 20D, id / 50D) AS dec", "0D AS pmra", "0D AS pmdec"
    ).transform(with_healpix_index("ra", "dec"))
    o = spark.range(n).selectExpr(
        "concat('k', lpad(id, 6, '0')) AS bk_simbad", "10D AS ra", "20D AS dec"
    ).transform(with_healpix_index("ra", "dec"))
    attached = spatial.attach_counterparts(s, o)
    assert attached.count() == n  # one candidate per star, not three thousand
    assert attached.filter(F.col("bk_simbad") == "k000000").count() >= n // 3


def test_every_object_can_be_kept(spark):
    s = spark.createDataFrame([(1, 10.0, 5.0, 0.0, 0.0)], "source_id long, ra double, dec double, pmra double, pmdec double")
    o = spark.createDataFrame([("a", 10.0, 5.0), ("b", 10.0, 5.0)], "bk_simbad string, ra double, dec double")
    s, o = (d.transform(with_healpix_index("ra", "dec")) for d in (s, o))
    assert [r.bk_simbad for r in spatial.attach_counterparts(s, o).collect()] == ["a"]
    every = spatial.attach_counterparts(s, o, distinct_positions=False).collect()
    assert sorted(r.bk_simbad for r in every) == ["a", "b"]


def test_hot_cell_is_split_by_skew_join(spark, tmp_path):
    """Half of the stars share one small field; AQE reads that partition in several tasks."""
    spark.range(200_000).selectExpr(
        "id", "IF(id % 2 = 0, 100D + (id % 1000) / 1e6D, pmod(id * 137.5D, 360D)) AS ra",
        "IF(id % 2 = 0, 40D, id % 1600 / 10D - 80D) AS dec",
    ).write.parquet(str(tmp_path / "l"))
    frame(spark, [(100.0, 40.0), *sphere_points(20, 2)], "_r", "other").write.parquet(str(tmp_path / "r"))
    left, right = (spark.read.parquet(str(tmp_path / x)) for x in "lr")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        pairs = spatial.pairs_within(left, right, 0.5)
        assert len(pairs.select("id").collect()) >= 100_000
        done = pairs.select("id", "other")
        done.collect()
        assert "skew=true" in plan_of(done)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("mode", ["pixel", "exact"])
def test_every_star_has_one_row_whatever_its_motion(spark, mode):
    """Stars at a pole, with NaN, null or absurd motion, or without a position."""
    nan = float("nan")
    stars_at = [
        (1, 10.0, 90.0, 5.0, 5.0),
        (2, 10.0, -89.9999, nan, 1.0),
        (3, 20.0, 5.0, nan, nan),
        (4, 20.0, 5.0, 1e15, -1e15),
        (5, None, 5.0, 1.0, 1.0),
        (6, nan, nan, 1.0, 1.0),
        (7, 30.0, 30.0, None, None),
        (8, 30.0, 89.0, 0.0, 7.2e6 * 60 / 16),
    ]
    rows = spark.createDataFrame(stars_at, "source_id long, ra double, dec double, pmra double, pmdec double")
    objects = spark.createDataFrame([("far", 200.0, -40.0), ("at", 30.0, 30.0)], "bk_simbad string, ra double, dec double")
    s, o = (df.transform(with_healpix_index("ra", "dec")) for df in (rows, objects))
    attached = spatial.attach_counterparts(s, o, mode=mode).collect()
    assert sorted(r.source_id for r in attached) == [1, 2, 3, 4, 5, 6, 7, 8]
    best = {r.source_id: r.bk_simbad for r in spatial.attach_nearest(s, o, mode=mode).collect()}
    assert best == {1: "-1", 2: "-1", 3: "-1", 4: "-1", 5: "-1", 6: "-1", 7: "at", 8: "-1"}


def test_motion_across_a_pole_is_followed(spark):
    """An object at 89.9995 moves 0.001 degrees north: over the pole to the other side."""
    moves = 0.001 * 3.6e6 / 16
    s = spark.createDataFrame([(1, 190.0, 89.9995, 0.0, moves)], "source_id long, ra double, dec double, pmra double, pmdec double")
    o = spark.createDataFrame([("over", 10.0, 89.9995), ("stays", 190.0, 89.9995)], "bk_simbad string, ra double, dec double")
    s, o = (df.transform(with_healpix_index("ra", "dec")) for df in (s, o))
    assert [r.bk_simbad for r in spatial.counterparts(s, o, mode="exact").collect()] == ["over"]


@pytest.mark.parametrize("mode", ["pixel", "exact"])
def test_wide_star_rows_are_shuffled_once(spark, mode):
    """With broadcasts off, only one exchange carries the columns that take no part in the match."""
    wide = spark.range(500).selectExpr(
        "id AS source_id", "id / 10.0D AS ra", "id / 20.0D AS dec", "1.0D AS pmra", "1.0D AS pmdec", "id * 3 AS payload"
    )
    objects = spark.range(500).selectExpr("string(id) AS bk_simbad", "id / 10.0D AS ra", "id / 20.0D AS dec")
    s, o = (df.transform(with_healpix_index("ra", "dec")) for df in (wide, objects))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spatial.attach_nearest(s, o, mode=mode)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert sum("payload" in lines[i + 1] for i in exchanges) == 1
    assert "BroadcastExchange" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("radius", [0.5, 20.0])
def test_nearest_within_against_brute_force(spark, radius):
    left = frame(spark, sphere_points(300, 11))
    right = frame(spark, [*sphere_points(150, 12), *sphere_points(20, 12)], "", "name")
    right = right.withColumn("name", F.concat(F.lit("n"), "name"))
    rows = left.collect()
    others = right.collect()
    got = spatial.nearest_within(left.unionByName(left), right, radius, "name").collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        away = sorted((round(separation((r.ra, r.dec), (o.ra, o.dec)), 9), o["name"]) for o in others)
        near = [a for a in away if a[0] <= radius]
        assert r.n_objects == len(near) and r.nearest == (near[0][1] if near else None)


def test_rings_end_early(spark):
    """A crowd in one place: its stars leave in the first ring, and the waiting ones are reported."""
    r = random.Random(2)
    crowd = [(50 + r.uniform(-0.01, 0.01), 20 + r.uniform(-0.01, 0.01)) for _ in range(300)]
    left, right = frame(spark, crowd + sphere_points(200, 13)), frame(spark, crowd[:150] + sphere_points(100, 14), "", "name")
    right = right.withColumn("name", F.concat(F.lit("n"), "name"))
    reports = []
    got = spatial.nearest_within(left, right, 5.0, "name", reports=reports).collect()
    others = right.collect()
    for x in got[::7]:
        away = sorted((round(separation((x.ra, x.dec), (o.ra, o.dec)), 9), o["name"]) for o in others)
        assert (x.n_objects, x.nearest) == (sum(a[0] <= 5.0 for a in away), away[0][1] if away[0][0] <= 5.0 else None)
    waits = [n for _, n in reports]
    assert len(waits) >= 3 and waits == sorted(waits, reverse=True) and waits[-1] <= 201


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 9, 20, 29])
def test_pixels_and_back(spark, depth):
    r = np.random.default_rng(depth)
    pixels = r.integers(0, 12 * 4**depth, 300)
    places = []
    for pixel, at in zip(pixels.tolist(), r.uniform(0.01, 0.99, (300, 2)).tolist()):
        x, y, z = healpix.pixel_vectors(*healpix.pixel_parts(np.array([pixel]), depth), depth, at)[0]
        places.append((pixel, math.degrees(math.atan2(y, x)), math.degrees(math.atan2(z, math.hypot(x, y)))))
    found = spark.createDataFrame(places, "pixel long, ra double, dec double").transform(with_healpix_index("ra", "dec", depth))
    wrong = found.where("pixel <> healpix_index").count()
    assert wrong == 0 if depth <= 20 else wrong <= 30  # doubles in degrees are coarser than the last pixels


@pytest.mark.parametrize("depth", range(5))
def test_pixel_radius_is_the_largest(depth):
    parts = healpix.pixel_parts(np.arange(12 * 4**depth), depth)
    middle = healpix.pixel_vectors(*parts, depth)
    corners = [healpix.pixel_vectors(*parts, depth, (a, b)) for a in (0, 1) for b in (0, 1)]
    chord_ = max(np.sqrt(((c - middle) ** 2).sum(axis=1)).max() for c in corners)
    assert math.isclose(math.degrees(2 * math.asin(chord_ / 2)), healpix.pixel_radius(depth), rel_tol=1e-9)


@pytest.mark.parametrize("order", [0, 2, 3, 8, 14])
def test_covering_tiles_hold_every_position_of_a_cone(spark, order):
    r = random.Random(order)
    for _ in range(6):
        center, radius = (r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1)))), r.choice([0.01, 1.0, 8.0, 40.0])
        ranges = healpix.disc_ranges(*center, radius, order)
        assert all(a <= b for a, b in ranges) and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) < 120
        points = [(center[0] + a, center[1] + b) for a, b in np.random.default_rng(order).uniform(-radius, radius, (3000, 2)).tolist()]
        points = [p for p in points + sphere_points(5000, 3) if abs(p[1]) <= 90 and separation(p, center) <= radius] + [center]
        found = frame(spark, points).transform(with_healpix_index("ra", "dec", order, "tile"))
        assert found.where(~spatial.in_ranges("tile", ranges)).count() == 0
        if order <= 3:
            assert set(spatial.covering_tiles(*center, radius, order)) == {t for a, b in ranges for t in range(a, b + 1)}
        covered = sum(b - a + 1 for a, b in ranges) * 41253 / (12 * 4**order)
        size = math.pi * (radius + 2 * healpix.pixel_radius(order) + radius / 2) ** 2
        assert covered <= max(size * 1.5, 12 * 41253 / (12 * 4**order))


def test_cones_open_covering_tiles_only(spark, tmp_path):
    df = frame(spark, sphere_points(20000, 3)).transform(with_healpix_index("ra", "dec", 2, "tile")).transform(with_healpix_index("ra", "dec", 6))
    df.repartition("tile").sortWithinPartitions("healpix_index").write.partitionBy("tile").parquet(str(tmp_path / "sky"))
    table = spark.read.parquet(str(tmp_path / "sky"))
    cone = spatial.cone_search(30.0, 20.0, 1 / 60, pixels=[("tile", 2), ("healpix_index", 6)])
    found = table.transform(cone)
    plan = plan_of(found)
    assert re.search(r"PartitionFilters: \[[^\]]*tile#\d+ (=|>=|IN)", plan) and "healpix_index" in plan.split("PushedFilters")[1]
    assert len(spatial.covering_tiles(30.0, 20.0, 1 / 60, 2)) == 1
    assert found.count() == table.transform(spatial.cone_search(30.0, 20.0, 1 / 60)).count()
    tiles = spatial.covering_tiles(30.0, 20.0, 5.0)
    plan = plan_of(table.transform(spatial.cone_search(30.0, 20.0, 5.0, tiles=("tile", tiles))))
    assert "PartitionFilters: [tile" in plan or "PartitionFilters: [isnotnull(tile" in plan
