"""Statistics (G11-G20) and layouts (W4-W10) against numpy restatements."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rackpulse.functions import collections as CL
from rackpulse.functions import scales as SC
from rackpulse.functions import timefns as TF
from rackpulse.operators import layout as L
from rackpulse.operators import stats as ST


def _groups(seed=3):
    rnd = random.Random(seed)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]       # a third-plus of the rows, many ties
    rows += [("wide", rnd.uniform(-1e6, 1e6)) for _ in range(1500)]
    rows += [("one", 42.0), ("two", 1.0), ("two", 3.0)]
    rows += [("nulls", None), ("nulls", 5.0)]
    return rows


@pytest.mark.parametrize("accuracy", [10000, 10])
def test_exact_quantiles_match_numpy(spark, accuracy):
    rows = _groups()
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.p): r.quantile for r in ST.exact_quantiles(df, ["g"], "v", probs, accuracy).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.percentile(vals, p * 100), rel=1e-12, abs=1e-9), (g, p)


def test_quantile_thresholds_ties_go_up(spark):
    df = spark.createDataFrame([(0, float(x)) for x in [1, 2, 3, 4, 5, 6, 7, 8]], "g int, v double")
    thr = ST.quantile_thresholds(df, ["g"], "v", 4).collect()[0].thresholds
    assert thr == pytest.approx([2.75, 4.5, 6.25])
    b = df.join(ST.quantile_thresholds(df, ["g"], "v", 4), "g") \
        .select("v", ST.threshold_index(F.col("v"), F.col("thresholds")).alias("b")).orderBy("v").collect()
    assert [r.b for r in b] == [0, 0, 1, 1, 2, 2, 3, 3]


def test_histogram_sturges_and_last_bin(spark):
    vals = [0.0, 0.1, 0.5, 1.0, 2.5, 9.99, 10.0] + [5.0] * 9
    h = ST.histogram(spark.createDataFrame([(v,) for v in vals], "v double"), "v").orderBy("bin").collect()
    assert len(h) == math.ceil(math.log2(len(vals)) + 1)
    assert sum(r.y for r in h) == len(vals)
    assert h[-1].y >= 2          # 9.99 and the maximum 10.0 share the last bin
    assert all(r.y == 0 for r in h if r.bin in (3,))  # an empty bin is kept
    fixed = ST.histogram(spark.createDataFrame([(v,) for v in vals], "v double"), "v", bins=2).collect()
    assert sorted(r.y for r in fixed) == [5, 11]   # a value equal to a threshold goes up


def test_basic_stats_skip_nan_and_empty_sum(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", None)], "g string, v double")
    got = {r.g: (r.lo, r.hi, r.total, r.mean, r.n) for r in ST.basic_stats(df, ["g"], "v").collect()}
    assert got["a"] == (1.0, 3.0, 4.0, 2.0, 2)
    assert got["b"] == (None, None, 0.0, None, 0)


def test_hierarchy_rollup_sums(spark):
    df = spark.createDataFrame([("r1", "n1", 1.0), ("r1", "n2", 2.0), ("r2", "n3", 4.0)], "r string, n string, v double")
    got = {(x.r, x.n, x.depth): x.value for x in ST.hierarchy_rollup(df, ["r", "n"], "v").collect()}
    assert got[(None, None, 0)] == 7.0 and got[("r1", None, 1)] == 3.0 and got[("r2", "n3", 2)] == 4.0


def test_flow_matrix_reverse_and_totals(spark):
    df = spark.createDataFrame([(1, 2, 5.0), (2, 1, 3.0), (1, 1, 1.0), (1, 2, 1.0)], "s int, d int, v double")
    got = {(r.s, r.d): (r.value, r.reverse_value, r.src_total) for r in ST.flow_matrix(df, "s", "d", "v").collect()}
    assert got == {(1, 2): (6.0, 3.0, 7.0), (2, 1): (3.0, 6.0, 3.0), (1, 1): (1.0, 1.0, 7.0)}


def test_grid_occupancy_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.9, 0.1), (0.5, 0.5)], "x double, y double")
    got = {(r.level, r.cx, r.cy): r.n for r in ST.grid_occupancy(df, "x", "y", 1).collect()}
    assert got == {(0, 0, 0): 4, (1, 0, 0): 1, (1, 1, 1): 2, (1, 1, 0): 1}


def test_convex_hull(spark):
    rnd = random.Random(9)
    pts = [(g, rnd.uniform(0, 10), rnd.uniform(0, 10)) for g in range(3) for _ in range(200)]
    pts += [(3, 0.0, 0.0), (3, 1.0, 1.0)]            # fewer than 3 distinct points: no hull
    df = spark.createDataFrame(pts, "g int, x double, y double").repartition(4)
    hull = ST.convex_hulls(df, "g", "x", "y").collect()
    assert not [r for r in hull if r.g == 3]
    for g in range(3):
        h = sorted([r for r in hull if r.g == g], key=lambda r: r.vertex)
        hv = np.array([(r.x, r.y) for r in h])
        assert len(hv) >= 3
        for (gg, x, y) in pts:
            if gg != g:
                continue
            for i in range(len(hv)):
                a, b = hv[i], hv[(i + 1) % len(hv)]
                assert (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) >= -1e-9


def test_polygon_area_centroid(spark):
    sq = [(1, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)])]
    r = ST.polygon_measures(spark.createDataFrame(sq, "p int, i int, x double, y double"), "p", "i", "x", "y").collect()[0]
    assert abs(r.area) == 4.0 and (r.cx, r.cy) == (1.0, 1.0)


def test_stack_offsets(spark):
    v = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (2, "a", 0.0), (2, "b", 0.0)], "x int, s string, y double")
    z = {(r.x, r.s): (r.y, r.y0) for r in L.stack(v, "x", "s", "y", "zero").collect()}
    assert z[(1, "b")] == (3.0, 1.0)
    e = {(r.x, r.s): (r.y, r.y0) for r in L.stack(v, "x", "s", "y", "expand").collect()}
    assert e[(1, "b")] == (0.75, 0.25) and e[(2, "a")] == (0.5, 0.0)
    sl = {(r.x, r.s): r.y0 for r in L.stack(v, "x", "s", "y", "silhouette").collect()}
    assert sl[(1, "a")] == 0.0 and sl[(2, "a")] == 2.0


def test_pie_and_intervals(spark):
    v = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    p = {r.k: (r.start_angle, r.end_angle) for r in L.pie(v, "k", "v").collect()}
    assert p["b"] == pytest.approx((0.0, 1.5 * math.pi)) and p["a"] == pytest.approx((1.5 * math.pi, 2 * math.pi))
    ch = spark.createDataFrame([("r", "x", 1.0, 0.5, 0.5), ("r", "y", 3.0, 0.5, 0.5)],
                               "parent string, child string, v double, px0 double, pdx double")
    got = {r.child: (r.x0, r.dx) for r in L.nested_intervals(ch, "parent", "child", "v").collect()}
    assert got == {"y": (0.5, 0.375), "x": (0.875, 0.125)}


def test_gap_interpolate_and_pairs(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 10, None), (0, 30, 4.0), (0, 40, None)], "g int, t long, v double")
    got = {r.t: r.filled for r in L.gap_interpolate(df, ["g"], "t", "v").collect()}
    assert got == {0: 1.0, 10: 2.0, 30: 4.0, 40: None}
    pr = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (0, 3, "c")], "g int, o int, v string")
    assert sorted((r.a, r.b) for r in L.adjacent_pairs(pr, ["g"], "o", "v").collect()) == [("a", "b"), ("b", "c")]


def test_gap_interpolate_chunked_against_loop(spark):
    import random
    rnd = random.Random(5)
    rows = [(g, t, (float(rnd.randint(0, 50)) if rnd.random() < 0.3 else None))
            for g in range(3) for t in range(0, 400 * (1 + 5 * (g == 0)), 10)]
    df = spark.createDataFrame(rows, "g int, t long, v double")
    for chunk in (1 << 30, 70, 25):
        got = {(r.g, r.t): r.filled for r in L.gap_interpolate(df, ["g"], "t", "v", chunk_seconds=chunk).collect()}
        for g in range(3):
            pts = [(t, v) for gg, t, v in rows if gg == g]
            for t, v in pts:
                prev = [(tt, vv) for tt, vv in pts if tt <= t and vv is not None]
                nxt = [(tt, vv) for tt, vv in pts if tt >= t and vv is not None]
                if v is not None:
                    exp = v
                elif not prev or not nxt:
                    exp = None
                else:
                    (pt, pv), (nt, nv) = prev[-1], nxt[0]
                    exp = pv + (nv - pv) * (t - pt) / (nt - pt)
                assert got[(g, t)] == (None if exp is None else pytest.approx(exp)), (chunk, g, t)


def test_path_length_and_distance(spark):
    pts = spark.createDataFrame([(0, 1, 0.0, 0.0), (0, 2, math.pi / 2, 0.0), (0, 3, math.pi / 2, math.pi / 2)],
                                "g int, o int, lon double, lat double")
    r = L.path_length(pts, ["g"], "o", [], "lon", "lat").collect()[0]
    assert r.length == pytest.approx(math.pi) and r.n_points == 3


def test_previous_row_hot_key_small_chunks(spark):
    from rackpulse.operators.series import previous_row
    rnd = random.Random(4)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 5), rnd.randint(0, 5000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t long, id int")
    got = {r.id: r.prev_id for r in previous_row(df, ["k"], "t", ["id"], ["id"], chunk_seconds=40).collect()}
    for k in {r[0] for r in rows}:
        seq = sorted((t, i) for kk, t, i in rows if kk == k)
        assert got[seq[0][1]] is None
        for (t0, a), (t1, b) in zip(seq, seq[1:]):
            assert got[b] == a


def test_scales(spark):
    df = spark.createDataFrame([(5.0,), (50000.0,), (200000.0,), (-4.0,)], "x double")
    r = df.select(
        SC.piecewise(F.col("x"), [0, 10000, 100000], [0, 0.5, 1], clamp=True).alias("pw"),
        SC.threshold(F.col("x"), [5.0, 100.0]).alias("th"),
        SC.round_half_up(F.lit(-2.5), 0).alias("rh"), SC.round_half_up(F.lit(2.345), 2).alias("rh2"),
        *[c.alias(n) for c, n in zip(SC.si_prefix(F.col("x")), ["e", "sym", "sc"])]).collect()
    assert [x.pw for x in r] == pytest.approx([0.00025, 0.5 + 40000 / 90000 * 0.5, 1.0, 0.0])
    assert [x.th for x in r] == [1, 2, 2, 0]
    assert r[0].rh == -2.0
    assert [(x.e, x.sym) for x in r] == [(0, ""), (3, "k"), (3, "k"), (0, "")]
    lo, hi = SC.bucket_bounds(F.lit(0), [5.0, 100.0])
    b = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).collect()[0]
    assert (b.lo, b.hi) == (None, 5.0)


def test_time_functions(spark):
    df = spark.createDataFrame([("2014-07-09 13:30:00",), ("2014-07-09 13:29:59.999",), ("2014-01-01 00:00:00",)],
                               "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    r = df.select(F.date_format(TF.round_to(F.col("ts"), "hour"), "HH:mm").alias("r"),
                  F.date_format(TF.ceil_to(F.col("ts"), "hour"), "HH:mm").alias("c"),
                  F.date_format(TF.floor_to(F.col("ts"), "week", 1), "yyyy-MM-dd").alias("wm"),
                  TF.week_of_year(F.col("ts"), 0).alias("u")).collect()
    assert [(x.r, x.c) for x in r] == [("14:00", "14:00"), ("13:00", "14:00"), ("00:00", "00:00")]
    assert r[0].wm == "2014-07-07" and r[2].u == 0 and r[0].u == 27
    unit, cnt = TF.time_step(F.lit(86_400_000.0))
    assert tuple(spark.range(1).select(unit, cnt).collect()[0]) == ("hour", 3)


def test_collections(spark):
    r = spark.range(1).select(
        CL.number_range(F.lit(0), F.lit(10), F.lit(3)).alias("nr"),
        CL.permute(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(F.lit(2), F.lit(0))).alias("pm"),
        CL.zip_shortest(F.array(F.lit(1), F.lit(2), F.lit(3)), F.array(F.lit(9))).alias("z"),
        CL.merge_arrays(F.array(F.lit(1)), F.array(F.lit(2), F.lit(3))).alias("m")).collect()[0]
    assert r.nr == [0, 3, 6, 9] and r.pm == ["c", "a"] and len(r.z) == 1 and r.m == [1, 2, 3]


def test_snapshot_diff_rules(spark):
    from rackpulse.operators.diff import snapshot_diff
    old = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "k string, id int")
    new = spark.createDataFrame([("b", 10), ("d", 11), ("d", 12)], "k string, id int")
    got = sorted((r.k, r.status, r.old_id, r.new_id) for r in snapshot_diff(old, new, "k", "id").collect())
    assert got == [("a", "exit", 1, None), ("b", "exit", 3, None), ("b", "update", 2, 10),
                   ("c", "exit", 4, None), ("d", "enter", None, 11)]


def _wiggle_loop(xs, ys):
    """The wiggle recurrence over series i and positions j, as plain loops."""
    n, m = len(ys), len(xs)
    o = o0 = 0.0
    base = [0.0]
    for j in range(1, m):
        s1 = sum(ys[i][j] for i in range(n))
        dx = xs[j] - xs[j - 1]
        s2 = 0.0
        for i in range(n):
            s3 = (ys[i][j] - ys[i][j - 1]) / (2 * dx)
            for k in range(i):
                s3 += (ys[k][j] - ys[k][j - 1]) / dx
            s2 += s3 * ys[i][j]
        o -= s2 / s1 * dx if s1 else 0
        base.append(o)
        o0 = min(o0, o)
    return [b - o0 for b in base]


def test_wiggle_and_densify(spark):
    xs = [1, 2, 4, 5]
    ys = [[1.0, 4.0, 2.0, 0.0], [3.0, 1.0, 5.0, 2.0], [0.0, 2.0, 2.0, 7.0]]
    rows = [(x, s, ys[i][j]) for i, s in enumerate("abc") for j, x in enumerate(xs) if ys[i][j] != 0.0]
    dense = L.densify(spark.createDataFrame(rows, "x int, s string, y double"), "x", "s", "y")
    assert dense.count() == 12
    got = {(r.x, r.s): r.y0 for r in L.stack_wiggle(dense, "x", "s", "y").collect()}
    base = _wiggle_loop(xs, ys)
    for j, x in enumerate(xs):
        assert got[(x, "a")] == pytest.approx(base[j])
        assert got[(x, "b")] == pytest.approx(base[j] + ys[0][j])


def test_wiggle_chunked_baseline(spark):
    # the running baseline cut into chunks of 1 and 2 x units gives the same offsets
    xs = [1, 2, 4, 5, 9]
    ys = [[1.0, 4.0, 2.0, 0.0, 3.0], [3.0, 1.0, 5.0, 2.0, 1.0], [0.0, 2.0, 2.0, 7.0, 4.0]]
    rows = [(x, s, ys[i][j]) for i, s in enumerate("abc") for j, x in enumerate(xs)]
    dense = spark.createDataFrame(rows, "x int, s string, y double")
    base = _wiggle_loop(xs, ys)
    for chunk in (1, 2):
        got = {(r.x, r.s): r.y0 for r in L.stack_wiggle(dense, "x", "s", "y", chunk=chunk).collect()}
        for j, x in enumerate(xs):
            assert got[(x, "a")] == pytest.approx(base[j])


def test_inside_out_order(spark):
    # maxima at x = 3 (a), 1 (b), 2 (c), 4 (d); sums 5, 4, 3, 9
    rows = [(1, "a", 1.0), (3, "a", 4.0), (1, "b", 4.0), (2, "c", 3.0), (4, "d", 9.0)]
    order = {r.s: r.position for r in L.inside_out_order(spark.createDataFrame(rows, "x int, s string, y double"),
                                                         "x", "s", "y").collect()}
    # dealt in max order b, c, a, d: b->bottom, c->top, a->top (3<4? no: top 3 < bottom 4 -> top), d->bottom
    assert [s for s, _ in sorted(order.items(), key=lambda kv: kv[1])] == ["d", "b", "c", "a"]


def test_delaunay_links_and_triangles(spark):
    from rackpulse.operators import view as V
    c = spark.createDataFrame([(0, 0, 0.0, 0.0), (0, 1, 10.0, 0.0), (0, 2, 5.0, 8.0), (0, 3, 5.0, -8.0)],
                              "g int, cluster_id int, px double, py double")
    assert sorted((r.a, r.b) for r in V.voronoi_links(c, ["g"]).collect()) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3)]
    assert sorted((r.a, r.b, r.c) for r in V.voronoi_triangles(c, ["g"]).collect()) == [(0, 1, 2), (0, 1, 3)]


def _links_by_circles(pts):
    """Links of the triangles whose circumcircle is empty (general position)."""
    import itertools

    out = set()
    for a, b, c in itertools.combinations(range(len(pts)), 3):
        (ax, ay), (bx, by), (cx, cy) = pts[a], pts[b], pts[c]
        d = 2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by))
        if d == 0:
            continue
        sa, sb, sc = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        u = (sa * (by - cy) + sb * (cy - ay) + sc * (ay - by)) / d, (sa * (cx - bx) + sb * (ax - cx) + sc * (bx - ax)) / d
        r = math.hypot(ax - u[0], ay - u[1])
        if all(math.hypot(x - u[0], y - u[1]) > r * (1 - 1e-12) for i, (x, y) in enumerate(pts) if i not in (a, b, c)):
            out |= {(a, b), (a, c), (b, c)}
    return out


@pytest.mark.parametrize("k", [13, 30])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_of_clustered_centres_with_outliers(k, seed):
    import random

    import pandas as pd
    from rackpulse.operators.view import delaunay_links
    rng = random.Random(seed)
    pts = [(400 + 12 * rng.random(), 300 + 9 * rng.random()) for _ in range(k - 2)] + [(3.0, 5.0), (790.0, 11.0)]
    got = delaunay_links(pd.DataFrame({"cluster_id": range(k), "px": [p[0] for p in pts], "py": [p[1] for p in pts]}))
    assert set(got) == _links_by_circles(pts)


def test_histogram_of_a_constant_column(spark):
    h = ST.histogram(spark.createDataFrame([(5.0,)] * 8, "v double"), "v").orderBy("bin").collect()
    assert [r.y for r in h] == [0, 0, 0, 8] and all(r.dx == 0 and r.x == 5 for r in h)


def test_zero_totals_give_empty_slices(spark):
    v = spark.createDataFrame([("g", "a", 0.0), ("g", "b", 0.0)], "g string, k string, v double")
    assert [(r.start_angle, r.end_angle) for r in L.pie(v, "k", "v", ["g"]).collect()] == [(0.0, 0.0)] * 2
    c = v.selectExpr("g", "k", "v", "0.25D as px0", "0.5D as pdx")
    assert [(r.x0, r.dx) for r in L.nested_intervals(c, "g", "k", "v").collect()] == [(0.25, 0.0)] * 2


def test_snapshot_diff_null_key(spark):
    from rackpulse.operators.diff import snapshot_diff
    old = spark.createDataFrame([(None, 1), (None, 2), (7, 3)], "k int, id int")
    new = spark.createDataFrame([(None, 8), (9, 10)], "k int, id int")
    got = {(r.k, r.status, r.old_id, r.new_id) for r in snapshot_diff(old, new, "k", "id").collect()}
    assert got == {(None, "update", 1, 8), (None, "exit", 2, None), (7, "exit", 3, None), (9, "enter", None, 10)}


def test_weeks_begin_with_the_week_of_the_first_of_january(spark):
    import datetime as dt
    days = [dt.datetime(y, m, d) for y in (2023, 2024, 2025) for m, d in ((1, 1), (1, 2), (1, 6), (1, 7), (1, 8), (6, 30), (12, 31))]

    def week(t, start):
        first = dt.date(t.year, 1, 1)
        before = (first.isoweekday() % 7 - start) % 7
        return ((t.date() - first).days + before) // 7

    rows = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz").select(
        "ts", TF.week_of_year(F.col("ts"), 0).alias("s"), TF.week_of_year(F.col("ts"), 1).alias("m")).collect()
    assert [(r.s, r.m) for r in rows] == [(week(r.ts, 0), week(r.ts, 1)) for r in rows]
    assert next(r.m for r in rows if r.ts == dt.datetime(2024, 1, 1)) == 0


def test_hours_a_zone_leaves_out_stay(spark):
    """2024-03-10 02:30 does not exist in Los Angeles; a time without zone has it."""
    import datetime as dt

    from rackpulse.operators.selection import stamp_name
    from rackpulse.tables import epoch_seconds
    t = dt.datetime(2024, 3, 10, 2, 30, 15, 123456)
    df = spark.createDataFrame([(t,)], "ts timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", z)
            ts = F.col("ts")
            r = df.select(TF.text(TF.floor_to(ts, "hour")).alias("h"), TF.text(TF.round_to(ts, "minute")).alias("m"), stamp_name(ts).alias("n"),
                          TF.iso_format(ts).alias("iso"), TF.text(TF.iso_parse(TF.iso_format(ts))).alias("back"), epoch_seconds(ts).alias("e")).first()
            assert tuple(r) == ("2024-03-10 02:00:00", "2024-03-10 02:30:00", "2024-03-10-02-30", "2024-03-10T02:30:15.123Z", "2024-03-10 02:30:15",
                                int(t.replace(tzinfo=dt.timezone.utc).timestamp()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quadtree_leaves_against_splitting(spark):
    """Cells are split while they hold several places, as in the definition."""
    import random

    from rackpulse.operators.stats import quadtree_leaves

    rng = random.Random(5)
    points = [("a", rng.random() ** 4, rng.random()) for _ in range(300)] + [("a", 0.25, 0.25)] * 5 + [("b", 3.0, 4.0)] * 3 + [("c", 0.0, 0.0), ("c", 8.0, 2.0)]
    bad = [("a", None, 1.0), ("c", float("nan"), 1.0)]
    got = sorted(tuple(r) for r in quadtree_leaves(spark.createDataFrame(points + bad, "g string, x double, y double"), ["g"], "x", "y", 20, 2).collect())
    want = []

    def split(g, cells, depth, cx, cy):
        if len(set(cells)) == 1 or depth == 20:
            return want.append((g, depth, cx, cy, len(cells)))
        parts = {}
        for px, py in cells:
            parts.setdefault((px >> (19 - depth), py >> (19 - depth)), []).append((px, py))
        for (qx, qy), own in parts.items():
            split(g, own, depth + 1, qx, qy)

    for g in "abc":
        own = [(x, y) for h, x, y in points if h == g]
        x0, y0 = min(x for x, _ in own), min(y for _, y in own)
        span = max(max(x for x, _ in own) - x0, max(y for _, y in own) - y0)
        cell = lambda v, low: min((1 << 20) - 1, int((v - low) / span * (1 << 20))) if span else 0  # noqa: E731, B023
        split(g, [(cell(x, x0), cell(y, y0)) for x, y in own], 0, 0, 0)
    assert got == sorted(want)


def test_trees_of_any_depth(spark):
    """A long chain, a wide node, a lost parent, two roots; a cycle is told."""
    import pytest

    from rackpulse.operators.trees import tree_partition, tree_rollup

    rows = [(i, i - 1 if i else None, float(i)) for i in range(70)] + [(100 + i, 5, 2.0) for i in range(50)] + [(300, 999, 4.0), (301, 300, None)]
    df = spark.createDataFrame(rows, "id long, parent long, v double")
    got = {r.id: r for r in tree_rollup(df, "id", "parent", "v").collect()}
    assert (got[0].depth, got[0].n_leaves, got[0].total) == (0, 51, 169.0)
    assert (got[69].depth, got[69].n_leaves, got[69].total) == (69, 1, 69.0) and got[120].depth == 6
    assert (got[300].parent, got[300].depth, got[300].total) == (None, 0, 0.0) and got[6].total == 69.0
    x = {r.id: (r.x, r.dx) for r in tree_partition(tree_rollup(df, "id", "parent", "v")).collect()}
    assert x[0] == (0.0, 1.0) and x[300] == (1.0, 0.0) and x[69] == x[6] == (0.0, 69 / 169)
    assert x[100][0] == pytest.approx(69 / 169) and x[149][0] == pytest.approx(167 / 169)
    assert tree_rollup(df.limit(0), "id", "parent", "v").count() == 0
    with pytest.raises(ValueError):
        tree_rollup(spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "id long, parent long, v double"), "id", "parent", "v").count()
