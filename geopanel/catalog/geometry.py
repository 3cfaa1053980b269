"""Polygon tables built from the embedding vectors.

Every vector gives 32 points in four rings of eight: two parts of two rings, around
39N 96W. Lengths are reported in kilometres, positions in metres to the centimetre.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from geopanel.catalog.inputs import table
from geopanel.catalog.registry import query
from geopanel.operators import geometry as G

_LAMBERT = G.LambertConic()


def _polygons(spark, sf_dir):
    def ring(number):
        def point(i):
            at = F.lit(number * 16) + i * 2
            return F.struct(
                (F.lit(-96.0) + F.get("v", at) * 20).alias("x"),
                (F.lit(39.0) + F.get("v", at + 1) * 10).alias("y"),
            )

        return F.transform(F.sequence(F.lit(0), F.lit(7)), point)

    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v")
    )
    return vectors.select(
        F.col("vec_id").alias("GEOID"),
        F.array(F.array(ring(0), ring(1)), F.array(ring(2), ring(3))).alias("parts"),
    )


_POINTS = """points AS (SELECT vec_id, r, i,
    -96.0 + CAST(embedding[r * 16 + i * 2 + 1] AS DOUBLE) * 20 AS x,
    39.0 + CAST(embedding[r * 16 + i * 2 + 2] AS DOUBLE) * 10 AS y
  FROM embeddings, range(4) a(r), range(8) b(i))"""

# The cone from its published parameters, worked out in SQL on its own: GRS 80, standard
# parallels 33 and 45 north, origin 39 north 96 west.
_XY = """given AS (SELECT 6378137::DOUBLE AS a, 1 / 298.257222101::DOUBLE AS f,
    radians(33) AS lat1, radians(45) AS lat2, radians(39) AS lat0, radians(-96) AS lon0),
  ellipsoid AS (SELECT *, sqrt(2 * f - f * f) AS e FROM given),
  lines AS (SELECT *, cos(lat1) / sqrt(1 - pow(e * sin(lat1), 2)) AS m1,
    cos(lat2) / sqrt(1 - pow(e * sin(lat2), 2)) AS m2,
    tan(pi() / 4 - lat1 / 2) / pow((1 - e * sin(lat1)) / (1 + e * sin(lat1)), e / 2) AS t1,
    tan(pi() / 4 - lat2 / 2) / pow((1 - e * sin(lat2)) / (1 + e * sin(lat2)), e / 2) AS t2,
    tan(pi() / 4 - lat0 / 2) / pow((1 - e * sin(lat0)) / (1 + e * sin(lat0)), e / 2) AS t0
    FROM ellipsoid),
  cone AS (SELECT *, a * m1 / (n * pow(t1, n)) AS scale
    FROM (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM lines)),
  xy AS (SELECT vec_id, r, i, scale * pow(t0, n) AS rho0, n * (radians(x) - lon0) AS theta,
    scale * pow(tan(pi() / 4 - radians(y) / 2)
      / pow((1 - e * sin(radians(y))) / (1 + e * sin(radians(y))), e / 2), n) AS rho
    FROM points, cone),
  projected AS (SELECT vec_id, r, i, rho * sin(theta) AS x, rho0 - rho * cos(theta) AS y
    FROM xy)"""


@query(f"""WITH {_POINTS} SELECT vec_id AS ORIG_FID, CAST(r // 2 AS INTEGER) AS part_no,
    CAST(r % 2 AS INTEGER) AS ring_no, count(*) AS vertices,
    round(min(x), 6) AS min_x, round(max(y), 6) AS max_y
  FROM points GROUP BY vec_id, r""")
def split_parts(spark, sf_dir):
    parts = G.split_parts(_polygons(spark, sf_dir))
    rings = parts.select("ORIG_FID", "part_no", F.posexplode("part").alias("ring_no", "ring"))
    return rings.select(
        "ORIG_FID", "part_no", "ring_no", F.size("ring").cast("bigint").alias("vertices"),
        F.array_min(F.transform("ring", lambda p: p.getField("x"))).alias("min_x"),
        F.array_max(F.transform("ring", lambda p: p.getField("y"))).alias("max_y"),
    )


def _vertices(df, part):
    rings = df.select("ORIG_FID", "part_no", F.posexplode(part).alias("ring_no", "ring"))
    points = rings.select(
        "ORIG_FID", "part_no", "ring_no", F.posexplode("ring").alias("vertex_no", "p")
    )
    return points.select(
        "ORIG_FID", "part_no", "ring_no", "vertex_no",
        F.round("p.x", 2).alias("x"), F.round("p.y", 2).alias("y"),
    )


_IDS = """vec_id AS ORIG_FID, CAST(r // 2 AS INTEGER) AS part_no, CAST(r % 2 AS INTEGER)
    AS ring_no, CAST(i AS INTEGER) AS vertex_no"""


@query(f"WITH {_POINTS}, {_XY} SELECT {_IDS}, round(x, 2) AS x, round(y, 2) AS y FROM projected")
def project_points(spark, sf_dir):
    """Conic projection of every vertex."""
    parts = G.split_parts(_polygons(spark, sf_dir))
    projected = parts.withColumn("part", G.project_part("part", _LAMBERT))
    return _vertices(projected, "part")


@query(f"""WITH {_POINTS} SELECT {_IDS},
    round({G.MERCATOR_RADIUS}::DOUBLE * radians(x), 2) AS x,
    round({G.MERCATOR_RADIUS}::DOUBLE * ln(tan({math.pi / 4!r}::DOUBLE + radians(y) / 2)), 2) AS y
  FROM points""")
def project_points_mercator(spark, sf_dir):
    """Web projection, whole polygons first and split afterwards."""
    projected = _polygons(spark, sf_dir).withColumn(
        "parts", G.project_parts("parts", G.web_mercator)
    )
    return _vertices(G.split_parts(projected), "part")


@query(f"""WITH {_POINTS}, {_XY}, edges AS (SELECT a.vec_id, a.r, a.i, a.x AS ax, a.y AS ay,
    b.x AS bx, b.y AS by_, sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS len,
    (a.x - b.x) * (a.y + b.y) / 2 AS area
    FROM projected a JOIN projected b
      ON a.vec_id = b.vec_id AND a.r = b.r AND b.i = (a.i + 1) % 8),
  rings AS (SELECT vec_id, r, sum(len) AS len, abs(sum(area)) AS area FROM edges GROUP BY ALL),
  middles AS (SELECT vec_id, r, (ax + bx) / 2 AS mx, (ay + by_) / 2 AS my FROM edges WHERE i = 0),
  holes AS (SELECT m.vec_id, m.r, count(*) FILTER ((ay > my) <> (by_ > my)
      AND mx < ax + (bx - ax) * (my - ay) / (by_ - ay)) % 2 AS hole
    FROM middles m JOIN edges e ON e.vec_id = m.vec_id AND e.r = m.r + 1 - 2 * (m.r % 2)
    GROUP BY ALL)
  SELECT vec_id AS ORIG_FID, CAST(r // 2 AS INTEGER) AS part_no,
    round(sum(len) / 1000, 3) AS length_km,
    round(abs(sum(area * (1 - 2 * hole))) / 1000000, 3) AS area_km2
  FROM rings JOIN holes USING (vec_id, r) GROUP BY vec_id, r // 2""")
def ring_measures(spark, sf_dir):
    """Perimeter and area of each projected part, rings within another subtracted."""
    parts = G.split_parts(_polygons(spark, sf_dir))
    projected = parts.withColumn("part", G.project_part("part", _LAMBERT))
    measured = G.measure_parts(projected)
    return measured.select(
        "ORIG_FID", "part_no", F.round(F.col("Shape_Leng") / 1000, 3).alias("length_km"),
        F.round(F.col("Shape_Area") / 1_000_000, 3).alias("area_km2"),
    )
