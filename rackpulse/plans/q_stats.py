"""Queries over table statistics and layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..operators import layout as L
from ..operators import stats as ST
from ..operators import trees as TR
from ..session import stage
from .registry import query

PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]
# (l_orderkey, l_linenumber) is not unique in the data: order lines fully.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


def rb(c):
    """Round to 6 places with a 1e-9 nudge (same rule as the oracles)."""
    return F.round(F.col(c) + 1e-9, 6).alias(c) if isinstance(c, str) else F.round(c + 1e-9, 6)


def r2(c):
    """Sums of cent amounts: exact to 2 places, so round there (large sums
    carry float noise at the 6th place)."""
    return F.round(F.col(c), 2).alias(c)


def _t(spark, sf_dir, name):
    return T.table(spark, sf_dir, name)


@query("basic_stats", """
SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
       round(coalesce(sum(l_extendedprice), 0), 2) AS total,
       round(avg(l_extendedprice) + 1e-9, 6) AS mean, count(l_extendedprice) AS n
FROM lineitem GROUP BY l_returnflag
""")
def q_basic_stats(spark, sf_dir):
    s = ST.basic_stats(_t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return s.select("l_returnflag", "lo", "hi", r2("total"), rb("mean"), "n")


@query("quantiles", " UNION ALL ".join(
    f"SELECT l_returnflag, CAST({p} AS DOUBLE) AS p, "
    f"round(quantile_cont(l_extendedprice, {p}) + 1e-9, 6) AS quantile FROM lineitem GROUP BY l_returnflag"
    for p in PROBS))
def q_quantiles(spark, sf_dir):
    q = ST.exact_quantiles(_t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", PROBS)
    return q.select("l_returnflag", "p", rb("quantile"))


@query("quantile_bucket", """
WITH t AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS t1,
                  quantile_cont(o_totalprice, 0.5) AS t2, quantile_cont(o_totalprice, 0.75) AS t3
           FROM orders GROUP BY o_orderstatus)
SELECT o.o_orderkey, o.o_orderstatus,
       CAST((o.o_totalprice >= t1)::INT + (o.o_totalprice >= t2)::INT + (o.o_totalprice >= t3)::INT AS INTEGER)
         AS bucket
FROM orders o JOIN t ON o.o_orderstatus = t.o_orderstatus
""")
def q_quantile_bucket(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    thr = ST.quantile_thresholds(o, ["o_orderstatus"], "o_totalprice", 4)
    return (o.join(thr, "o_orderstatus")
            .select("o_orderkey", "o_orderstatus",
                    ST.threshold_index(F.col("o_totalprice"), F.col("thresholds")).alias("bucket")))


@query("histogram", """
WITH st AS (SELECT count(l_extendedprice) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
            FROM lineitem),
m AS (SELECT n, lo, hi, CAST(ceil(log2(n) + 1) AS INTEGER) AS m FROM st),
md AS (SELECT n, lo, hi, m, (hi - lo) / m AS dx FROM m),
b AS (SELECT CASE WHEN md.m > 1 THEN
             CAST(len(list_filter(list_transform(range(1, md.m), lambda i: md.dx * i + md.lo),
                                  lambda t: t <= l.l_extendedprice)) AS INTEGER) ELSE 0 END AS bin
      FROM lineitem l, md WHERE l.l_extendedprice IS NOT NULL),
c AS (SELECT bin, count(*) AS y FROM b GROUP BY bin),
spine AS (SELECT CAST(unnest(range(0, m)) AS INTEGER) AS bin, lo, dx, n FROM md)
SELECT s.bin, round(s.dx * s.bin + s.lo + 1e-9, 6) AS x, round(s.dx + 1e-9, 6) AS dx,
       coalesce(c.y, 0) AS y, round(coalesce(c.y, 0) / s.n + 1e-9, 6) AS frequency
FROM spine s LEFT JOIN c ON s.bin = c.bin
""")
def q_histogram(spark, sf_dir):
    h = ST.histogram(_t(spark, sf_dir, "lineitem"), "l_extendedprice")
    return h.select(F.col("bin").cast("int").alias("bin"), rb("x"), rb("dx"), "y", rb("frequency"))


@query("nest_rollup", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity) + 1e-9, 6) AS total,
       CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linestatus) AS INTEGER) AS key_order
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_nest_rollup(spark, sf_dir):
    n = ST.nest_rollup(_t(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return n.select("l_returnflag", "l_linestatus", "n", rb("total"), "key_order")


HIER_FROM = """
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _hier(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey")))


@query("hierarchy_rollup", f"""
SELECT r_name, n_name, c_mktsegment,
       CAST((GROUPING(r_name) = 0)::INT + (GROUPING(n_name) = 0)::INT + (GROUPING(c_mktsegment) = 0)::INT
            AS INTEGER) AS depth,
       round(sum(o_totalprice), 2) AS value
{HIER_FROM}
GROUP BY ROLLUP (r_name, n_name, c_mktsegment)
""")
def q_hierarchy_rollup(spark, sf_dir):
    h = ST.hierarchy_rollup(_hier(spark, sf_dir), ["r_name", "n_name", "c_mktsegment"], "o_totalprice")
    return h.select("r_name", "n_name", "c_mktsegment", "depth", r2("value"))


@query("flow_matrix", """
WITH f AS (SELECT c.c_nationkey AS src, s.s_nationkey AS dst, sum(l.l_extendedprice) AS value
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
           GROUP BY ALL)
SELECT a.src, a.dst, round(a.value, 2) AS value,
       round(coalesce(b.value, 0), 2) AS reverse_value,
       round(sum(a.value) OVER (PARTITION BY a.src), 2) AS src_total
FROM f a LEFT JOIN f b ON a.src = b.dst AND a.dst = b.src
""")
def q_flow_matrix(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("src"))
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("dst"))
    flows = (l.join(o, l.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
             .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    m = ST.flow_matrix(flows, "src", "dst", "l_extendedprice")
    return m.select("src", "dst", r2("value"), r2("reverse_value"), r2("src_total"))


@query("grid_occupancy", """
WITH e AS (SELECT min(o_totalprice) AS x0, max(o_totalprice) AS x1,
                  min(CAST(o_custkey AS DOUBLE)) AS y0, max(CAST(o_custkey AS DOUBLE)) AS y1 FROM orders),
lv AS (SELECT unnest(range(0, 5)) AS level),
c AS (SELECT lv.level,
             CASE WHEN e.x1 = e.x0 THEN 0 ELSE CAST(least(pow(2, lv.level) - 1, greatest(0,
                  floor((o.o_totalprice - e.x0) / ((e.x1 - e.x0) / pow(2, lv.level))))) AS BIGINT) END AS cx,
             CASE WHEN e.y1 = e.y0 THEN 0 ELSE CAST(least(pow(2, lv.level) - 1, greatest(0,
                  floor((CAST(o.o_custkey AS DOUBLE) - e.y0) / ((e.y1 - e.y0) / pow(2, lv.level))))) AS BIGINT) END
               AS cy
      FROM orders o, e, lv)
SELECT CAST(level AS INTEGER) AS level, cx, cy, count(*) AS n FROM c GROUP BY ALL
""")
def q_grid_occupancy(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_totalprice", F.col("o_custkey").cast("double").alias("y"))
    return ST.grid_occupancy(o, "o_totalprice", "y", 4)


@query("quadtree_leaves", """
WITH p AS (SELECT o_orderpriority AS g, o_totalprice AS x, CAST(o_custkey AS DOUBLE) AS y FROM orders),
e AS (SELECT g, min(x) AS x0, min(y) AS y0, greatest(max(x) - min(x), max(y) - min(y)) AS span FROM p GROUP BY g),
c AS (SELECT g, CASE WHEN span > 0 THEN CAST(least(16777215, floor((x - x0) / span * 16777216)) AS BIGINT) ELSE 0 END AS cx,
             CASE WHEN span > 0 THEN CAST(least(16777215, floor((y - y0) / span * 16777216)) AS BIGINT) ELSE 0 END AS cy
      FROM p JOIN e USING (g)),
d AS (SELECT g, cx, cy, count(*) AS n FROM c GROUP BY ALL),
lv AS (SELECT unnest(range(0, 25)) AS depth),
cells AS (SELECT g, depth, cx // CAST(pow(2, 24 - depth) AS BIGINT) AS qx, cy // CAST(pow(2, 24 - depth) AS BIGINT) AS qy,
                 count(*) AS places, sum(n) AS n FROM d, lv GROUP BY ALL),
leaf AS (SELECT d.g, d.cx, d.cy, min(lv.depth) AS depth
         FROM d JOIN lv ON true
         JOIN cells k ON k.g = d.g AND k.depth = lv.depth AND k.places = 1
              AND k.qx = d.cx // CAST(pow(2, 24 - lv.depth) AS BIGINT) AND k.qy = d.cy // CAST(pow(2, 24 - lv.depth) AS BIGINT)
         GROUP BY d.g, d.cx, d.cy)
SELECT d.g, CAST(leaf.depth AS INTEGER) AS depth, d.cx // CAST(pow(2, 24 - leaf.depth) AS BIGINT) AS cx,
       d.cy // CAST(pow(2, 24 - leaf.depth) AS BIGINT) AS cy, d.n
FROM d JOIN leaf USING (g, cx, cy)
""")
def q_quadtree_leaves(spark, sf_dir):
    """Adaptive quadtrees of the orders of each priority, by price and customer."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("g"), "o_totalprice", "o_custkey")
    return ST.quadtree_leaves(o, ["g"], "o_totalprice", "o_custkey")


@query("hull_per_group", """
WITH RECURSIVE p AS (SELECT DISTINCT c_nationkey AS g, c_acctbal AS x, CAST(c_custkey AS DOUBLE) AS y FROM customer),
e AS (SELECT a.g, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM p a JOIN p b ON a.g = b.g
      WHERE (a.x, a.y) <> (b.x, b.y)
        AND NOT EXISTS (SELECT 1 FROM p r WHERE r.g = a.g AND (r.x, r.y) <> (a.x, a.y) AND (r.x, r.y) <> (b.x, b.y)
              AND NOT ((b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x) > 0
                       OR ((b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x) = 0
                           AND (r.x - a.x) * (b.x - a.x) + (r.y - a.y) * (b.y - a.y) > 0
                           AND (r.x - b.x) * (a.x - b.x) + (r.y - b.y) * (a.y - b.y) > 0)))),
s AS (SELECT g, arg_min(x, (x, y)) AS x, arg_min(y, (x, y)) AS y FROM p GROUP BY g),
walk(g, vertex, x, y) AS (
  SELECT s.g, 0, s.x, s.y FROM s
  UNION ALL
  SELECT w.g, w.vertex + 1, e.bx, e.by_ FROM walk w JOIN e ON e.g = w.g AND e.ax = w.x AND e.ay = w.y
  WHERE w.vertex < 10000),
cyc AS (SELECT g, min(vertex) FILTER (WHERE vertex > 0 AND (x, y) = (SELECT (s.x, s.y) FROM s WHERE s.g = walk.g))
          AS n FROM walk GROUP BY g)
SELECT w.g AS c_nationkey, CAST(w.vertex AS INTEGER) AS vertex, w.x, w.y
FROM walk w JOIN cyc c ON w.g = c.g WHERE c.n >= 3 AND w.vertex < c.n
""")
def q_hull_per_group(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal",
                                             F.col("c_custkey").cast("double").alias("k"))
    return ST.convex_hulls(c, "c_nationkey", "c_acctbal", "k")


@query("polygon_area", f"""
WITH v AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice AS y,
                  coalesce(lag(l_quantity) OVER w, last_value(l_quantity) OVER wa) AS px,
                  coalesce(lag(l_extendedprice) OVER w, last_value(l_extendedprice) OVER wa) AS py
           FROM lineitem
           WINDOW w AS (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}),
                  wa AS (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
g AS (SELECT l_orderkey, count(*) AS n_vertices, sum(py * x - px * y) * 0.5 AS area,
             sum((px + x) * (px * y - x * py)) AS sx, sum((py + y) * (px * y - x * py)) AS sy
      FROM v GROUP BY l_orderkey)
SELECT l_orderkey, n_vertices, round(area + 1e-9, 6) AS area,
       round(CASE WHEN area <> 0 THEN sx * (-1.0 / (area * 6)) END + 1e-9, 6) AS cx,
       round(CASE WHEN area <> 0 THEN sy * (-1.0 / (area * 6)) END + 1e-9, 6) AS cy
FROM g
""")
def q_polygon_area(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_quantity")
    p = ST.polygon_measures(l, "l_orderkey", LINE_ORDER, "l_quantity", "l_extendedprice")
    return p.select("l_orderkey", "n_vertices", rb("area"), rb("cx"), rb("cy"))


@query("adjacent_pairs", f"""
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey AS a,
                      lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS b
               FROM lineitem) t WHERE b IS NOT NULL
""")
def q_adjacent_pairs(spark, sf_dir):
    return L.adjacent_pairs(_t(spark, sf_dir, "lineitem"), ["l_orderkey"], LINE_ORDER, "l_partkey")


STACK_CTE = """
vals AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS x, l_returnflag AS series, sum(l_quantity) AS y
         FROM lineitem GROUP BY ALL),
tot AS (SELECT x, sum(y) AS t, count(*) AS c FROM vals GROUP BY x)
"""


def _stack_values(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem")
    return (l.groupBy(F.year("l_shipdate").cast("int").alias("x"), F.col("l_returnflag").alias("series"))
            .agg(F.sum("l_quantity").alias("y")))


@query("stack_zero", f"""
WITH {STACK_CTE}
SELECT x, series, round(y + 1e-9, 6) AS y,
       round(coalesce(sum(y) OVER (PARTITION BY x ORDER BY series
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1e-9, 6) AS y0
FROM vals
""")
def q_stack_zero(spark, sf_dir):
    s = L.stack(_stack_values(spark, sf_dir), "x", "series", "y", "zero")
    return s.select("x", "series", rb("y"), rb("y0"))


@query("stack_expand", f"""
WITH {STACK_CTE},
e AS (SELECT v.x, v.series, CASE WHEN t.t = 0 THEN 1.0 / t.c ELSE v.y / t.t END AS s
      FROM vals v JOIN tot t ON v.x = t.x)
SELECT x, series, round(s + 1e-9, 6) AS y,
       round(coalesce(sum(s) OVER (PARTITION BY x ORDER BY series
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1e-9, 6) AS y0
FROM e
""")
def q_stack_expand(spark, sf_dir):
    s = L.stack(_stack_values(spark, sf_dir), "x", "series", "y", "expand")
    return s.select("x", "series", rb("y"), rb("y0"))


@query("stack_silhouette", f"""
WITH {STACK_CTE}
SELECT v.x, v.series, round(v.y + 1e-9, 6) AS y,
       round((SELECT max(t) FROM tot) / 2.0 - t.t / 2.0 +
             coalesce(sum(v.y) OVER (PARTITION BY v.x ORDER BY v.series
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1e-9, 6) AS y0
FROM vals v JOIN tot t ON v.x = t.x
""")
def q_stack_silhouette(spark, sf_dir):
    s = L.stack(_stack_values(spark, sf_dir), "x", "series", "y", "silhouette")
    return s.select("x", "series", rb("y"), rb("y0"))


@query("cumulative_share", f"""
WITH v AS (SELECT r_name, n_name, sum(o_totalprice) AS value {HIER_FROM} GROUP BY r_name, n_name),
a AS (SELECT *, coalesce(sum(value) OVER (PARTITION BY r_name ORDER BY value DESC, n_name
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                * (2 * pi() / sum(value) OVER (PARTITION BY r_name)) AS s,
             value * (2 * pi() / sum(value) OVER (PARTITION BY r_name)) AS w
      FROM v)
SELECT r_name, n_name, round(value, 2) AS value, round(s + 1e-9, 6) AS start_angle,
       round(s + w + 1e-9, 6) AS end_angle
FROM a
""")
def q_cumulative_share(spark, sf_dir):
    v = _hier(spark, sf_dir).groupBy("r_name", "n_name").agg(F.sum("o_totalprice").alias("value"))
    p = L.pie(v, "n_name", "value", ["r_name"])
    return p.select("r_name", "n_name", r2("value"), rb("start_angle"), rb("end_angle"))


@query("nested_intervals", f"""
WITH rv AS (SELECT r_name, sum(o_totalprice) AS value {HIER_FROM} GROUP BY r_name),
r1 AS (SELECT r_name, value,
              coalesce(sum(value) OVER (ORDER BY value DESC, r_name
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              / sum(value) OVER () AS x0,
              value / sum(value) OVER () AS dx FROM rv),
nv AS (SELECT r_name, n_name, sum(o_totalprice) AS value {HIER_FROM} GROUP BY r_name, n_name),
n1 AS (SELECT n.r_name, n.n_name, r.x0 + coalesce(sum(n.value) OVER (PARTITION BY n.r_name
              ORDER BY n.value DESC, n.n_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              / sum(n.value) OVER (PARTITION BY n.r_name) * r.dx AS x0,
              n.value / sum(n.value) OVER (PARTITION BY n.r_name) * r.dx AS dx
       FROM nv n JOIN r1 r ON n.r_name = r.r_name)
SELECT 1 AS level, r_name AS name, round(x0 + 1e-9, 6) AS x0, round(dx + 1e-9, 6) AS dx FROM r1
UNION ALL
SELECT 2 AS level, n_name AS name, round(x0 + 1e-9, 6) AS x0, round(dx + 1e-9, 6) AS dx FROM n1
""")
def q_nested_intervals(spark, sf_dir):
    # nation values once (one pass over the join), written as a small table;
    # region values are sums of their nations
    nv0 = stage(_hier(spark, sf_dir).groupBy("r_name", "n_name").agg(F.sum("o_totalprice").alias("value")),
                "nation_values")
    rv = (nv0.groupBy("r_name").agg(F.sum("value").alias("value"))
          .withColumn("root", F.lit("")).withColumn("px0", F.lit(0.0)).withColumn("pdx", F.lit(1.0)))
    r1 = L.nested_intervals(rv, "root", "r_name", "value")
    nv = nv0.join(r1.select("r_name", F.col("x0").alias("px0"), F.col("dx").alias("pdx")), "r_name")
    n1 = L.nested_intervals(nv, "r_name", "n_name", "value")
    return (r1.select(F.lit(1).alias("level"), F.col("r_name").alias("name"), rb("x0"), rb("dx"))
            .unionByName(n1.select(F.lit(2).alias("level"), F.col("n_name").alias("name"), rb("x0"), rb("dx"))))


@query("gap_interpolate", """
WITH h AS (SELECT event_type, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) * 3600 AS t, sum(value) AS v
           FROM events GROUP BY ALL),
b AS (SELECT event_type, min(t) AS t0, max(t) AS t1 FROM h GROUP BY event_type),
s AS (SELECT event_type, unnest(range(t0, t1 + 1, 3600)) AS t FROM b),
j AS (SELECT s.event_type, s.t, h.v FROM s LEFT JOIN h ON s.event_type = h.event_type AND s.t = h.t),
n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER wb AS pt,
                last_value(v IGNORE NULLS) OVER wb AS pv,
                last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER wf AS nt,
                last_value(v IGNORE NULLS) OVER wf AS nv
      FROM j WINDOW wb AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    wf AS (PARTITION BY event_type ORDER BY t DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_type, t, round(v + 1e-9, 6) AS raw,
       round(CASE WHEN v IS NOT NULL THEN v WHEN nt = pt THEN pv
                  ELSE pv + (nv - pv) * (CAST(t - pt AS DOUBLE) / CAST(nt - pt AS DOUBLE)) END + 1e-9, 6) AS filled
FROM n
""")
def q_gap_interpolate(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    h = (ev.groupBy("event_type", (F.floor(T.epoch_seconds(F.col("ts")) / 3600) * 3600).cast("long").alias("t"))
         .agg(F.sum("value").alias("v")))
    spine = (h.groupBy("event_type").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
             .select("event_type", F.explode(F.sequence("t0", "t1", F.lit(3600).cast("long"))).alias("t")))
    g = L.gap_interpolate(spine.join(h, ["event_type", "t"], "left"), ["event_type"], "t", "v",
                          chunk_seconds=7 * 86400)
    return g.select("event_type", "t", rb("raw"), rb("filled"))


def _rad(c):
    return F.radians(c.cast("double"))


@query("path_length", """
WITH p AS (SELECT o_custkey, o_orderdate, o_orderkey, radians(CAST(o_orderkey % 360 - 180 AS DOUBLE)) AS lon,
                  radians(CAST(o_orderkey % 170 - 85 AS DOUBLE)) AS lat FROM orders),
s AS (SELECT o_custkey, lag(lon) OVER w AS lon1, lag(lat) OVER w AS lat1, lon AS lon2, lat AS lat2 FROM p
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
d AS (SELECT o_custkey, atan2(sqrt(pow(cos(lat2) * sin(lon2 - lon1), 2)
                                   + pow(cos(lat1) * sin(lat2) - sin(lat1) * cos(lat2) * cos(lon2 - lon1), 2)),
                              sin(lat1) * sin(lat2) + cos(lat1) * cos(lat2) * cos(lon2 - lon1)) AS seg FROM s)
SELECT o_custkey, round(coalesce(sum(seg), 0) + 1e-9, 6) AS length, count(*) AS n_points FROM d GROUP BY o_custkey
""")
def q_path_length(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_custkey", T.epoch_seconds(F.col("o_orderdate")).alias("t"), "o_orderkey",
        _rad(F.col("o_orderkey") % 360 - 180).alias("lon"), _rad(F.col("o_orderkey") % 170 - 85).alias("lat"))
    p = L.path_length(o, ["o_custkey"], "t", ["o_orderkey"], "lon", "lat")
    return p.select("o_custkey", rb("length"), "n_points")


@query("geo_distance", """
WITH p AS (SELECT o_orderkey, radians(CAST(o_custkey % 360 - 180 AS DOUBLE)) AS lon1,
                  radians(CAST(o_custkey % 170 - 85 AS DOUBLE)) AS lat1,
                  radians(CAST(o_orderkey % 360 - 180 AS DOUBLE)) AS lon2,
                  radians(CAST(o_orderkey % 170 - 85 AS DOUBLE)) AS lat2 FROM orders)
SELECT o_orderkey, round(atan2(sqrt(pow(cos(lat2) * sin(lon2 - lon1), 2)
                                    + pow(cos(lat1) * sin(lat2) - sin(lat1) * cos(lat2) * cos(lon2 - lon1), 2)),
                               sin(lat1) * sin(lat2) + cos(lat1) * cos(lat2) * cos(lon2 - lon1)) + 1e-9, 6) AS dist
FROM p
""")
def q_geo_distance(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    d = L.great_circle(_rad(F.col("o_custkey") % 360 - 180), _rad(F.col("o_custkey") % 170 - 85),
                       _rad(F.col("o_orderkey") % 360 - 180), _rad(F.col("o_orderkey") % 170 - 85))
    return o.select("o_orderkey", rb(d).alias("dist"))


@query("stack_wiggle", f"""
WITH {STACK_CTE},
d AS (SELECT x, series, y, y - lag(y) OVER (PARTITION BY series ORDER BY x) AS dy,
             CAST(x - lag(x) OVER (PARTITION BY series ORDER BY x) AS DOUBLE) AS dx FROM vals),
s AS (SELECT *, dy / (2 * dx) + coalesce(sum(dy / dx) OVER (PARTITION BY x ORDER BY series
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s3 FROM d),
px AS (SELECT x, sum(y) AS s1, sum(s3 * y) AS s2, max(dx) AS dx FROM s GROUP BY x),
o AS (SELECT x, -sum(CASE WHEN dx IS NULL THEN 0 WHEN s1 = 0 THEN 0 ELSE s2 / s1 * dx END)
                OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o FROM px),
b AS (SELECT x, o - min(o) OVER () AS base FROM o)
SELECT v.x, v.series, round(v.y + 1e-9, 6) AS y,
       round(b.base + coalesce(sum(v.y) OVER (PARTITION BY v.x ORDER BY v.series
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1e-9, 6) AS y0
FROM vals v JOIN b ON v.x = b.x
""")
def q_stack_wiggle(spark, sf_dir):
    dense = L.densify(_stack_values(spark, sf_dir), "x", "series", "y")
    s = L.stack_wiggle(dense, "x", "series", "y", chunk=4)
    return s.select("x", "series", rb("y"), rb("y0"))


@query("stack_inside_out", f"""
WITH RECURSIVE {STACK_CTE},
mx AS (SELECT series, x AS xmax FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY y DESC, x) AS r
                                      FROM vals) t WHERE r = 1),
sm AS (SELECT v.series, sum(v.y) AS total, any_value(m.xmax) AS xmax FROM vals v JOIN mx m ON v.series = m.series
       GROUP BY v.series),
o AS (SELECT *, row_number() OVER (ORDER BY xmax, series) AS i FROM sm),
deal(i, top, bottom, tops, bottoms) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])
  UNION ALL
  SELECT d.i + 1,
         CASE WHEN d.top < d.bottom THEN d.top + o.total ELSE d.top END,
         CASE WHEN d.top < d.bottom THEN d.bottom ELSE d.bottom + o.total END,
         CASE WHEN d.top < d.bottom THEN list_append(d.tops, o.series) ELSE d.tops END,
         CASE WHEN d.top < d.bottom THEN d.bottoms ELSE list_append(d.bottoms, o.series) END
  FROM deal d JOIN o ON o.i = d.i + 1),
fin AS (SELECT list_concat(list_reverse(bottoms), tops) AS ord FROM deal ORDER BY i DESC LIMIT 1),
pos AS (SELECT unnest(ord) AS name, CAST(generate_subscripts(ord, 1) - 1 AS INTEGER) AS series FROM fin)
SELECT v.x, v.series AS name, p.series, round(v.y + 1e-9, 6) AS y,
       round(coalesce(sum(v.y) OVER (PARTITION BY v.x ORDER BY p.series
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1e-9, 6) AS y0
FROM vals v JOIN pos p ON v.series = p.name
""")
def q_stack_inside_out(spark, sf_dir):
    """W6 inside-out order, then a zero-offset stack in that order."""
    v = _stack_values(spark, sf_dir)
    order = L.inside_out_order(v, "x", "series", "y")
    ordered = v.join(order, "series").withColumnRenamed("series", "name").withColumnRenamed("position", "series")
    s = L.stack(ordered.select("x", "series", "y"), "x", "series", "y", "zero")
    return s.join(order.withColumnRenamed("series", "name").withColumnRenamed("position", "series"), "series") \
        .select("x", "name", "series", rb("y"), rb("y0"))


@query("nest_entries", """
SELECT l_returnflag, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linestatus) - 1 AS INTEGER) AS pos,
       l_linestatus, round(sum(l_quantity), 2) AS total
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_nest_entries(spark, sf_dir):
    """G15 nested form: per return flag, a map line status -> summed quantity,
    shown as its entries in order."""
    nested = ST.nest_entries(_t(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity")
    return nested.select("l_returnflag", F.posexplode(F.map_entries("values")).alias("pos", "e")).select(
        "l_returnflag", "pos", F.col("e.key").alias("l_linestatus"), F.round("e.value", 2).alias("total"))


# A tree of uneven depth from the customers: a customer's parent is the one whose
# key is a half, third or quarter of its own; only childless customers' balances count.
TREE = """
WITH RECURSIVE t0 AS (SELECT c_custkey AS id, c_custkey // (2 + c_custkey % 3) AS p, abs(c_acctbal) AS v FROM customer),
t AS (SELECT a.id, b.id AS parent, a.v FROM t0 a LEFT JOIN t0 b ON b.id = a.p AND a.p < a.id),
way AS (SELECT id, id AS anc, 0 AS steps FROM t
        UNION ALL SELECT w.id, t.parent, w.steps + 1 FROM way w JOIN t ON t.id = w.anc WHERE t.parent IS NOT NULL),
leaf AS (SELECT id, v FROM t WHERE id NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)),
depths AS (SELECT id, max(steps) AS depth FROM way GROUP BY id),
sums AS (SELECT w.anc AS id, count(*) AS n_leaves, sum(l.v) AS total FROM leaf l JOIN way w USING (id) GROUP BY w.anc),
rolled AS (SELECT t.id, t.parent, CAST(depth AS INTEGER) AS depth, n_leaves, total FROM t JOIN depths USING (id) JOIN sums USING (id))"""


def _tree(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr("c_custkey div (2 + c_custkey % 3)").alias("p"), F.abs("c_acctbal").alias("v"))
    return TR.tree_rollup(c.withColumn("parent", F.when(F.col("p") < F.col("id"), F.col("p"))), "id", "parent", "v")


@query("tree_rollup", TREE + """
SELECT id, parent, depth, n_leaves, round(total + 1e-9, 2) AS total FROM rolled
""")
def q_tree_rollup(spark, sf_dir):
    return _tree(spark, sf_dir).withColumn("total", r2("total"))


@query("tree_partition", TREE + """
, put AS (SELECT id, coalesce(sum(total) OVER (PARTITION BY parent ORDER BY total DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap FROM rolled),
edge AS (SELECT w.id, sum(put.gap) AS x0 FROM way w JOIN put ON put.id = w.anc GROUP BY w.id),
whole AS (SELECT sum(total) AS t FROM rolled WHERE parent IS NULL)
SELECT r.id, r.parent, r.depth, round(x0 / t + 1e-9, 6) AS x, round(total / t + 1e-9, 6) AS dx FROM rolled r JOIN edge USING (id), whole
""")
def q_tree_partition(spark, sf_dir):
    return TR.tree_partition(_tree(spark, sf_dir)).select("id", "parent", "depth", rb("x").alias("x"), rb("dx").alias("dx"))
