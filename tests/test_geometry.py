from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from geopanel.operators import geometry as G

SCHEMA = "GEOID string, name string, parts array<array<array<struct<x:double,y:double>>>>"
RECTANGLE = [(0.0, 0.0), (3.0, 0.0), (3.0, 2.0), (0.0, 2.0)]
HOLE = [(1.0, 0.5), (1.0, 1.5), (2.0, 1.5), (2.0, 0.5)]


@pytest.fixture
def polygons(spark):
    closed = [*RECTANGLE, RECTANGLE[0]]
    return spark.createDataFrame(
        [("a", "A", [[RECTANGLE], [closed, HOLE]]), ("b", "B", [[closed]])], SCHEMA
    )


def test_split_keeps_the_source(polygons, rows):
    out = G.split_parts(polygons)
    assert rows(out, "ORIG_FID", "name", "part_no") == [("a", "A", 0), ("a", "A", 1), ("b", "B", 0)]


def test_measures(polygons):
    out = {
        (r.ORIG_FID, r.part_no): (r.Shape_Leng, r.Shape_Area)
        for r in G.measure_parts(G.split_parts(polygons)).collect()
    }
    assert out == {("a", 0): (10.0, 6.0), ("a", 1): (14.0, 5.0), ("b", 0): (10.0, 6.0)}


def _project(one, projection, lon, lat):
    x, y = projection(F.col("lon"), F.col("lat"))
    return one(x, lon=lon, lat=lat), one(y, lon=lon, lat=lat)


def test_lambert(one):
    lambert = G.LambertConic()
    assert _project(one, lambert, -96.0, 39.0) == pytest.approx((0, 0), abs=1e-6)
    # Scale is true on the standard parallels: a short step east has its ground length.
    for lat in G.LAMBERT_PARALLELS:
        x0, y0 = _project(one, lambert, -96.0, lat)
        x1, y1 = _project(one, lambert, -95.999, lat)
        e2 = lambert.e ** 2
        radius = G.GRS80_RADIUS * math.cos(math.radians(lat)) / math.sqrt(
            1 - e2 * math.sin(math.radians(lat)) ** 2
        )
        assert math.hypot(x1 - x0, y1 - y0) == pytest.approx(radius * math.radians(0.001), rel=1e-7)
    west, east = (_project(one, lambert, lon, 45.0) for lon in (-106.0, -86.0))
    assert west[0] == pytest.approx(-east[0]) and west[1] == pytest.approx(east[1])


def test_lambert_published_example(one):
    # Snyder 1987, p. 296: Clarke 1866, parallels 33 and 45, origin 23N 96W, point 35N 75W.
    lambert = G.LambertConic(
        origin=(-96.0, 23.0), radius=6378206.4, inverse_flattening=294.9786982
    )
    x, y = _project(one, lambert, -75.0, 35.0)
    assert (x, y) == pytest.approx((1894410.9, 1564649.5), abs=0.5)


def test_web_mercator(one):
    x, y = _project(one, G.web_mercator, 180.0, 0.0)
    assert (x, y) == pytest.approx((20037508.342789, 0.0), abs=1e-5)
    # The square world ends where y reaches the same length.
    assert _project(one, G.web_mercator, 0.0, 85.0511287798)[1] == pytest.approx(
        20037508.34, abs=0.5
    )


def test_projecting_and_splitting_commute(polygons, rows):
    first = G.split_parts(
        polygons.withColumn("parts", G.project_parts("parts", G.web_mercator))
    )
    second = G.split_parts(polygons).withColumn("part", G.project_part("part", G.web_mercator))
    assert first.select("part").collect() == second.select("part").collect()


def _square(x, y, size, clockwise=False):
    ring = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    return ring[::-1] if clockwise else ring


@pytest.mark.parametrize("outer", [False, True])
@pytest.mark.parametrize("hole", [False, True])
@pytest.mark.parametrize("island", [False, True])
def test_holes_subtract_in_whatever_direction(spark, outer, hole, island):
    far = 4_000_000.0
    parts = [
        ([_square(0.0, 0.0, 10.0, outer), _square(2.0, 2.0, 4.0, hole)], 84.0),
        # An island in the hole, and a second outer ring beside the first.
        ([_square(3.0, 3.0, 1.0, island), _square(2.0, 2.0, 4.0, hole), _square(0.0, 0.0, 10.0, outer)], 85.0),
        ([_square(0.0, 0.0, 10.0, outer), _square(20.0, 0.0, 1.0, hole)], 101.0),
        # A hole that touches its ring in one corner.
        ([_square(0.0, 0.0, 10.0, outer), [(0.0, 0.0), (3.0, 1.0), (1.0, 3.0)]], 96.0),
        # Far from the origin, small squares keep their digits.
        ([_square(far, far, 0.001, outer)], 1e-6), ([], 0.0), ([[]], 0.0), ([[(1.0, 1.0)]], 0.0),
    ]
    frame = spark.createDataFrame([(p,) for p, _ in parts],
                                  "part array<array<struct<x:double,y:double>>>")
    got = [r.Shape_Area for r in G.measure_parts(frame).collect()]
    assert got == pytest.approx([area for _, area in parts], rel=1e-5)
