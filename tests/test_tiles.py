"""Counts, nearest and pairs by tile: bounded rows a disc, crowded tiles in parts, bounded arrays in a task."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import pointtree
from starloom.functions.pointtree import PointTree
from starloom.operators import discs, spatial

from .test_spatial import frame, separation, sphere_points, unit


def field(n, seed, width=4.0):
    r = random.Random(seed)
    return [(40 + r.uniform(0, width), 10 + r.uniform(0, width)) for _ in range(n)]


@pytest.fixture
def kept(monkeypatch):
    """Rows of each staged table, by label."""
    rows, stage = {}, spatial.stage

    def counting(df, label):
        staged = stage(df, label)
        rows[label] = rows.get(label, 0) + staged.count()
        return staged

    monkeypatch.setattr(spatial, "stage", counting)
    return rows


def test_f1_cone_count_keeps_few_rows_a_cone(spark, kept):
    """However dense the points: what is kept and shuffled for a cone are the few tiles that it touches."""
    points, around = field(40_000, 1), field(30, 2)
    got = spatial.count_in_cones(frame(spark, points), frame(spark, around), 1.0).collect()
    vectors = np.array([unit(*p) for p in points])
    for r in got:
        away = np.degrees(2 * np.arcsin(np.linalg.norm(vectors - unit(r.ra, r.dec), axis=1) / 2))
        assert r.n_obs == (away <= 1.0).sum()
    assert kept["disc-cover"] <= 30 * 16


def test_f3_crowded_tiles_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(discs, "MOST_POINTS", 40)
    monkeypatch.setattr(discs, "MOST_DISCS", 7)
    nan, inf = float("nan"), float("inf")
    points = field(900, 3) + sphere_points(100, 4) + [(41.0, 11.0)] * 60
    odd = [(None, 1.0), (41.0, nan), (41.0, 91.0), (inf, 11.0)]
    around = [*field(40, 5), (41.0, 11.0), (41.0, 11.0), *odd]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points + odd)], "id int, ra double, dec double")
    centers = spark.createDataFrame([(i, *p) for i, p in enumerate(around)], "id int, ra double, dec double")
    got = {r.id: r.n_obs for r in spatial.count_in_cones(df, centers, 0.5).collect()}
    assert got == {i: sum(separation(p, c) <= 0.5 for p in points) if i < 42 else 0 for i, c in enumerate(around)}


def test_f5_nearest_keeps_few_rows_an_object(spark, kept, monkeypatch):
    """Tiles of stars and of objects in parts, each part with its own nearest; few rows are kept for an object."""
    monkeypatch.setattr(discs, "MOST_POINTS", 300)
    monkeypatch.setattr(discs, "MOST_DISCS", 20)
    places, spots = field(4_000, 6), field(60, 7)
    objects = frame(spark, spots + spots[:5], "", "name").withColumn("name", F.concat(F.lit("n"), F.lpad("name", 3, "0")))
    got = spatial.nearest_within(frame(spark, places + places[:20]), objects, 1.0, "name").collect()
    assert len(got) == 4_020
    for r in got[::40]:
        away = sorted((round(separation((r.ra, r.dec), p), 9), f"n{i:03d}") for i, p in enumerate(spots + spots[:5]))
        near = [name for d, name in away if d <= 1.0]
        assert (r.n_objects, r.nearest) == (len(near), near[0] if near else None)
    assert kept["disc-cover"] <= 60 * 16


def test_f4_arrays_of_a_task_are_bounded(monkeypatch):
    """A task looks at a bounded number of pairs at a time, however many discs, points and matches there are."""
    monkeypatch.setattr(pointtree, "AT_ONCE", 256)
    r = np.random.default_rng(8)
    points, centers = (v / np.linalg.norm(v, axis=1)[:, None] for v in (r.normal(size=(3_000, 3)), r.normal(size=(200, 3))))
    weight, reach = r.integers(1, 4, 3_000), r.uniform(0.1, 2.0, 200)
    away = np.linalg.norm(points[None] - centers[:, None], axis=2)
    tree, sizes = PointTree(points, weight), []
    descend = tree._descend

    def watched(*args, **options):
        for found in descend(*args, **options):
            sizes.append(len(found[0]))
            yield found

    tree._descend = watched
    assert (tree.count(centers, reach, reach**2) == ((away <= reach[:, None]) * weight).sum(axis=1)).all()
    who, row, ring = tree.nearest(centers, [0.001, 0.02, 0.4, 2.0], 4.0)
    assert dict(zip(who.tolist(), row.tolist())) == dict(enumerate(away.argmin(axis=1).tolist()))
    assert (ring == np.searchsorted([0.001, 0.02, 0.4, 2.0], away.min(axis=1))[who]).all()
    assert len(sizes) > 200 and max(sizes) <= 256


def test_f2_pairs_cover_cones_with_few_pixels(spark, kept, monkeypatch):
    covers, cover = [], spatial.disc_cover

    def counting(df, *args, **options):
        made = cover(df, *args, **options)
        covers.append(made.count())
        return made

    monkeypatch.setattr(spatial, "disc_cover", counting)
    points, around = field(3_000, 9, 1.0), field(100, 10, 1.0)
    right = spark.createDataFrame([(i, *p, 0.1) for i, p in enumerate(around)], "c int, ra_r double, dec_r double, radius_deg double")
    got = {(r.id, r.c) for r in spatial.pairs_in_cones(frame(spark, points), right).collect()}
    assert got == {(i, c) for i, p in enumerate(points) for c, q in enumerate(around) if separation(p, q) <= 0.1}
    assert covers[0] <= 40 * 100 and not kept
