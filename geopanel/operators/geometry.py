"""Polygon tables: split parts, project, measure.

A polygon is ``parts -> rings -> vertices`` with vertices ``struct<x, y>``. All steps
are higher-order column functions and run row by row inside the scan's stage.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.functions.scalar import ColumnLike, col

# Ellipsoid and projection parameters of the stored layers.
GRS80_RADIUS = 6378137.0
GRS80_INVERSE_FLATTENING = 298.257222101
LAMBERT_PARALLELS = (33.0, 45.0)
LAMBERT_ORIGIN = (-96.0, 39.0)
MERCATOR_RADIUS = 6378137.0


def split_parts(df: DataFrame, parts: str = "parts", source_id: str = "GEOID") -> DataFrame:
    """One row per part, keeping the id of the polygon it came from."""
    others = [c for c in df.columns if c not in (parts, source_id)]
    return df.select(
        F.col(source_id).alias("ORIG_FID"), *others,
        F.posexplode(parts).alias("part_no", "part"),
    )


class LambertConic:
    """Lambert conformal conic on an ellipsoid, two standard parallels.

    The cone constants are numbers worked out once; ``x`` and ``y`` are expressions
    over longitude and latitude in degrees.
    """

    def __init__(
        self, parallels=LAMBERT_PARALLELS, origin=LAMBERT_ORIGIN,
        radius=GRS80_RADIUS, inverse_flattening=GRS80_INVERSE_FLATTENING,
    ):
        f = 1 / inverse_flattening
        self.e = math.sqrt(2 * f - f * f)
        lat1, lat2 = (math.radians(p) for p in parallels)
        self.lon0 = math.radians(origin[0])
        m1, m2 = self._m(lat1), self._m(lat2)
        t1, t2 = self._t(lat1), self._t(lat2)
        self.n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        self.scale = radius * m1 / (self.n * t1**self.n)
        self.rho0 = self.scale * self._t(math.radians(origin[1])) ** self.n

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (self.e * math.sin(lat)) ** 2)

    def _t(self, lat: float) -> float:
        s = self.e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def __call__(self, lon: ColumnLike, lat: ColumnLike) -> tuple[Column, Column]:
        phi = F.radians(col(lat))
        s = F.lit(self.e) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(self.e / 2))
        rho = F.lit(self.scale) * F.pow(t, F.lit(self.n))
        theta = F.lit(self.n) * (F.radians(col(lon)) - F.lit(self.lon0))
        return rho * F.sin(theta), F.lit(self.rho0) - rho * F.cos(theta)


def web_mercator(lon: ColumnLike, lat: ColumnLike) -> tuple[Column, Column]:
    """Spherical Mercator in metres from degrees."""
    r = F.lit(MERCATOR_RADIUS)
    return (
        r * F.radians(col(lon)),
        r * F.log(F.tan(F.lit(math.pi / 4) + F.radians(col(lat)) / 2)),
    )


Projection = Callable[[Column, Column], tuple[Column, Column]]


def project_ring(ring: ColumnLike, projection: Projection) -> Column:
    def point(v: Column) -> Column:
        x, y = projection(v.getField("x"), v.getField("y"))
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(col(ring), point)


def project_part(part: ColumnLike, projection: Projection) -> Column:
    return F.transform(col(part), lambda ring: project_ring(ring, projection))


def project_parts(parts: ColumnLike, projection: Projection) -> Column:
    return F.transform(col(parts), lambda part: project_part(part, projection))


def _edges(ring: Column, term: Callable[[Column, Column], Column]) -> Column:
    """Sum a term over the edges of a ring, closing it if it is open.

    Pairs each vertex with the next one and the last with the first; the extra edge
    of an already closed ring has length and area 0.
    """
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))),
                         F.slice(ring, 1, 1))
    return F.aggregate(
        F.zip_with(ring, following, term), F.lit(0.0), lambda total, x: total + x
    )


def ring_length(ring: ColumnLike) -> Column:
    return _edges(
        col(ring),
        lambda a, b: F.hypot(b.getField("x") - a.getField("x"), b.getField("y") - a.getField("y")),
    )


def ring_area(ring: ColumnLike) -> Column:
    """Signed area: positive counter-clockwise.

    Measured from the first vertex, as the products of projected metres would cancel each
    other's leading digits.
    """
    ring = col(ring)
    x, y = F.get(ring, F.lit(0)).getField("x"), F.get(ring, F.lit(0)).getField("y")
    return _edges(
        ring,
        lambda a, b: (a.getField("x") - x) * (b.getField("y") - y) / 2
        - (b.getField("x") - x) * (a.getField("y") - y) / 2,
    )


def in_ring(x: Column, y: Column, ring: ColumnLike) -> Column:
    """Is a point inside a ring: does a ray to the right cross it an odd number of times?"""
    def crossing(a: Column, b: Column) -> Column:
        over = (a.getField("y") > y) != (b.getField("y") > y)
        at = a.getField("x") + (b.getField("x") - a.getField("x")) * (
            y - a.getField("y")) / (b.getField("y") - a.getField("y"))
        return F.when(over, F.when(x < at, 1.0).otherwise(0.0)).otherwise(0.0)

    return _edges(col(ring), crossing) % 2 == 1


def part_length(part: ColumnLike) -> Column:
    return F.aggregate(
        F.transform(col(part), ring_length), F.lit(0.0), lambda total, x: total + x
    )


def part_area(part: ColumnLike) -> Column:
    """Area of a part: a ring within an odd number of the others is a hole, in whatever direction.

    A ring lies where the middle of its first edge does, so rings may touch in points. An
    island in a hole adds up again.
    """
    rings = col(part)

    def signed(ring: Column, number: Column) -> Column:
        first, second = F.get(ring, F.lit(0)), F.get(ring, F.lit(1))
        x = (first.getField("x") + F.coalesce(second, first).getField("x")) / 2
        y = (first.getField("y") + F.coalesce(second, first).getField("y")) / 2
        around = F.size(F.filter(
            rings, lambda other, at: (at != number) & in_ring(x, y, other)))
        size = F.abs(ring_area(ring))
        return F.when(around % 2 == 1, -size).otherwise(size)

    return F.abs(
        F.aggregate(F.transform(rings, signed), F.lit(0.0), lambda total, x: total + x)
    )


def measure_parts(df: DataFrame, part: str = "part") -> DataFrame:
    """Add perimeter and area of each part."""
    return df.withColumns({"Shape_Leng": part_length(part), "Shape_Area": part_area(part)})
