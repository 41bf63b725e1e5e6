"""Queries over the 2-D view operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..operators import view as V
from .q_cluster import GROUP, ITERATIONS, POINTS_CTE, _fitted, _points, lloyd_sql, r6cols
from .registry import query

X, Y = "filereads", "filewrites"   # the default view
W, H = V.WIDTH, V.HEIGHT
DIMS = V.DIMENSIONS

EXTENT_SQL = f"""
ext AS (SELECT server, min({X}) AS xlo, max({X}) AS xhi, min({Y}) AS ylo, max({Y}) AS yhi
        FROM pts GROUP BY server)
"""


def lin(v, lo, hi, r0, r1):
    return f"(CASE WHEN {hi} - {lo} = 0 THEN {float(r0)} ELSE {float(r0)} + ({v} - {lo}) / ({hi} - {lo}) * {float(r1 - r0)} END)"


@query("dim_pair", f"""
WITH {POINTS_CTE}
{" UNION ALL ".join(f"SELECT server, day, rn, '{x}' AS xdim, '{y}' AS ydim, {x} AS x, {y} AS y FROM pts"
                    for x in DIMS for y in DIMS if x != y)}
""")
def q_dim_pair(spark, sf_dir):
    return V.dim_pairs(_points(spark, sf_dir, staged=False), ["server", "day", "rn"])


@query("linear_scale", f"""
WITH {POINTS_CTE}, {EXTENT_SQL}
SELECT p.server, p.day, p.rn, round({lin(f"p.{X}", "e.xlo", "e.xhi", 0, W)} + 1e-9, 6) AS px,
       round({lin(f"p.{Y}", "e.ylo", "e.yhi", H, 0)} + 1e-9, 6) AS py
FROM pts p JOIN ext e ON p.server = e.server
""")
def q_linear_scale(spark, sf_dir):
    s = V.scale_view(_points(spark, sf_dir), GROUP, X, Y)
    return r6cols(s.select("server", "day", "rn", "px", "py"), ["px", "py"])


@query("dim_extent", f"""
WITH {POINTS_CTE}
{" UNION ALL ".join(f"SELECT server, '{d}' AS dim, min({d}) AS lo, max({d}) AS hi FROM pts GROUP BY server"
                    for d in DIMS)}
""")
def q_dim_extent(spark, sf_dir):
    return V.dim_extent(_points(spark, sf_dir, staged=False), GROUP)


@query("nice_ticks", f"""
WITH {POINTS_CTE},
ext AS ({" UNION ALL ".join(f"SELECT server, '{d}' AS dim, min({d}) AS lo, max({d}) AS hi FROM pts GROUP BY server" for d in DIMS)}),
st AS (SELECT *, pow(10.0, floor(log10((hi - lo) / 10))) AS s0 FROM ext WHERE hi > lo),
st2 AS (SELECT *, CASE WHEN 10 / (hi - lo) * s0 <= 0.15 THEN s0 * 10
                       WHEN 10 / (hi - lo) * s0 <= 0.35 THEN s0 * 5
                       WHEN 10 / (hi - lo) * s0 <= 0.75 THEN s0 * 2 ELSE s0 END AS step FROM st)
SELECT server, dim, step, floor(lo / step) * step AS nice_lo, ceil(hi / step) * step AS nice_hi,
       i, round(i * step, 6) AS tick
FROM st2, LATERAL (SELECT unnest(generate_series(CAST(ceil(lo / step) AS BIGINT),
                                                 CAST(floor(hi / step) AS BIGINT))) AS i) g
""")
def q_nice_ticks(spark, sf_dir):
    ext = V.dim_extent(_points(spark, sf_dir, staged=False), GROUP)
    t = V.nice_ticks(ext, GROUP + ["dim"])
    return t.withColumn("tick", F.round("tick", 6))


VORONOI_SQL = f"""
{lloyd_sql(ITERATIONS)}, {EXTENT_SQL},
sp AS (SELECT p.server, p.day, p.rn, {lin(f"p.{X}", "e.xlo", "e.xhi", 0, W)} AS vx,
              {lin(f"p.{Y}", "e.ylo", "e.yhi", H, 0)} AS vy FROM pts p JOIN ext e ON p.server = e.server),
sc AS (SELECT c.server, c.cluster_id, {lin(f"c.{X}", "e.xlo", "e.xhi", 0, W)} AS vx,
              {lin(f"c.{Y}", "e.ylo", "e.yhi", H, 0)} AS vy FROM c{ITERATIONS} c JOIN ext e ON c.server = e.server),
vd AS (SELECT p.server, p.day, p.rn, c.cluster_id,
              (p.vx - c.vx) * (p.vx - c.vx) + (p.vy - c.vy) * (p.vy - c.vy) AS d2
       FROM sp p JOIN sc c ON p.server = c.server),
cells AS (SELECT server, day, rn, cluster_id AS cell FROM
          (SELECT *, row_number() OVER (PARTITION BY server, day, rn ORDER BY d2, cluster_id) AS k FROM vd) t
          WHERE k = 1)
"""


@query("voronoi_assign", f"""
WITH {POINTS_CTE}, {VORONOI_SQL}
SELECT server, day, rn, cell FROM cells
""")
def q_voronoi_assign(spark, sf_dir):
    p = _points(spark, sf_dir)
    a = V.voronoi_assign(p, _fitted(spark, sf_dir), GROUP, X, Y)
    return a.select("server", "day", "rn", "cell")


@query("voronoi_counts", f"""
WITH {POINTS_CTE}, {VORONOI_SQL}
SELECT server, cell, count(*) AS n_points,
       round(count(*) / sum(count(*)) OVER (PARTITION BY server) + 1e-9, 6) AS share
FROM cells GROUP BY server, cell
""")
def q_voronoi_counts(spark, sf_dir):
    p = _points(spark, sf_dir)
    c = V.cell_counts(V.voronoi_assign(p, _fitted(spark, sf_dir), GROUP, X, Y), GROUP)
    return r6cols(c, ["share"])


def _scaled_centers(spark, sf_dir):
    p = _points(spark, sf_dir)
    ext = V.view_extent(p, GROUP, X, Y)
    return V.scale_with_extent(_fitted(spark, sf_dir), ext, GROUP, X, Y)


@query("voronoi_cells")
def q_voronoi_cells(spark, sf_dir):
    return V.voronoi_cells(_scaled_centers(spark, sf_dir), GROUP)


DELAUNAY_SQL = """
u AS (SELECT * FROM sc c WHERE NOT EXISTS (SELECT 1 FROM sc e WHERE e.server = c.server
      AND e.cluster_id < c.cluster_id AND e.vx = c.vx AND e.vy = c.vy)),
tri AS (SELECT a.server, a.cluster_id AS a, b.cluster_id AS b, c.cluster_id AS c,
               a.vx AS ax, a.vy AS ay, b.vx AS bx, b.vy AS by_, c.vx AS cx, c.vy AS cy
        FROM u a JOIN u b ON a.server = b.server AND a.cluster_id < b.cluster_id
                 JOIN u c ON c.server = a.server AND b.cluster_id < c.cluster_id),
dd AS (SELECT *, 2 * (ax * (by_ - cy) + bx * (cy - ay) + cx * (ay - by_)) AS d FROM tri),
cc AS (SELECT *, ((ax * ax + ay * ay) * (by_ - cy) + (bx * bx + by_ * by_) * (cy - ay)
                  + (cx * cx + cy * cy) * (ay - by_)) / d AS ux,
                 ((ax * ax + ay * ay) * (cx - bx) + (bx * bx + by_ * by_) * (ax - cx)
                  + (cx * cx + cy * cy) * (bx - ax)) / d AS uy FROM dd WHERE d <> 0),
rr AS (SELECT *, (ax - ux) * (ax - ux) + (ay - uy) * (ay - uy) AS r2 FROM cc),
del AS (SELECT server, a, b, c FROM rr t WHERE NOT EXISTS (
          SELECT 1 FROM u o WHERE o.server = t.server AND o.cluster_id NOT IN (t.a, t.b, t.c)
            AND (o.vx - t.ux) * (o.vx - t.ux) + (o.vy - t.uy) * (o.vy - t.uy) < t.r2 * (1 - 1e-9)))
"""


@query("voronoi_links", f"""
WITH {POINTS_CTE}, {VORONOI_SQL}, {DELAUNAY_SQL},
n AS (SELECT server, count(*) AS k FROM u GROUP BY server)
SELECT DISTINCT server, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b FROM (
  SELECT server, a, b FROM del UNION ALL SELECT server, a, c FROM del UNION ALL SELECT server, b, c FROM del
  UNION ALL SELECT x.server, x.cluster_id, y.cluster_id FROM u x JOIN u y
    ON x.server = y.server AND x.cluster_id < y.cluster_id JOIN n ON n.server = x.server WHERE n.k = 2) e
""")
def q_voronoi_links(spark, sf_dir):
    return V.voronoi_links(_scaled_centers(spark, sf_dir), GROUP)


@query("voronoi_triangles", f"""
WITH {POINTS_CTE}, {VORONOI_SQL}, {DELAUNAY_SQL}
SELECT server, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CAST(c AS INTEGER) AS c FROM del
""")
def q_voronoi_triangles(spark, sf_dir):
    return V.voronoi_triangles(_scaled_centers(spark, sf_dir), GROUP)


COUNT2D_CTE = """
c2 AS (SELECT CAST(trunc(value) AS INTEGER) % 60 AS temp, CAST(user_id % 123 AS INTEGER) * 60 AS fan,
              count(*) AS n FROM events GROUP BY ALL)
"""


def _count2d(spark, sf_dir):
    ev = T.table(spark, sf_dir, "events").select(
        (F.col("value").cast("int") % 60).alias("temp"), ((F.col("user_id") % 123) * 60).cast("int").alias("fan"))
    return V.count_2d(ev, "temp", "fan")


@query("count_2d", f"WITH {COUNT2D_CTE} SELECT temp, fan, n FROM c2")
def q_count_2d(spark, sf_dir):
    return _count2d(spark, sf_dir)


@query("quantize_bucket", f"""
WITH {COUNT2D_CTE},
d AS (SELECT min(n) AS lo, max(n) * 0.75 AS hi FROM c2)
SELECT temp, fan, n, CASE WHEN d.hi <> d.lo THEN
       CAST(greatest(0, least(8, floor(9 * (n - d.lo) / (d.hi - d.lo)))) AS INTEGER) END AS bucket
FROM c2, d
""")
def q_quantize_bucket(spark, sf_dir):
    c = _count2d(spark, sf_dir)
    ext = c.select(F.struct(F.min("n").cast("double").alias("lo"),
                            (F.max("n") * 0.75).cast("double").alias("hi"))).scalar()
    d = c.withColumn("_e", ext)
    return d.select("temp", "fan", "n", V.quantize(F.col("n"), F.col("_e.lo"), F.col("_e.hi"), 9).alias("bucket"))


@query("ordinal_code", """
WITH f AS (SELECT p_brand, min(p_partkey) AS first_pos FROM part GROUP BY p_brand)
SELECT p_brand, first_pos, CAST(row_number() OVER (ORDER BY first_pos, p_brand) - 1 AS INTEGER) AS code,
       CAST((row_number() OVER (ORDER BY first_pos, p_brand) - 1) % 20 AS INTEGER) AS slot
FROM f
""")
def q_ordinal_code(spark, sf_dir):
    return V.ordinal_codes(T.table(spark, sf_dir, "part"), "p_brand", "p_partkey")

