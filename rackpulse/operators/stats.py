"""Statistics over tables (G11-G18, G20): extents, exact quantiles, quantile
and threshold buckets, histograms, nested roll-ups, flow matrices, grid
occupancy and polygon measures.

Exact quantiles never sort a whole group in one task: an approximate
percentile brackets the wanted rank, rows below the bracket are only counted,
and only the distinct values inside the bracket are ranked. A group whose
bracket misses (possible only for tiny groups) is redone over its full range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def basic_stats(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Extent, sum (0 when empty; NaN skipped), mean, count."""
    v = F.when(~F.isnan(value), F.col(value))
    return df.groupBy(*group).agg(F.min(v).alias("lo"), F.max(v).alias("hi"),
                                  F.coalesce(F.sum(v), F.lit(0.0)).alias("total"),
                                  F.avg(v).alias("mean"), F.count(v).alias("n"))


def _quantile_pass(df, group, value, bounds):
    """Values at 0-based ranks ``_lo`` and ``_hi`` per (group, p), ranking only
    the distinct values inside [L, U]. ``bounds`` has group, pi, L, U, _lo, _hi.

    A row meets its group's brackets as one array. It is counted once by how
    many lower ends it reaches (which tells, for every p, the rows below the
    bracket) and once more, by its value, for each bracket it lies in: few rows
    do. A window over that short list gives cumulative ranks."""
    arrays = bounds.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("pi", "L", "U"))).alias("_b"))
    j = df.select(*group, F.col(value).alias("_v")).where(F.col("_v").isNotNull()).join(arrays, group)
    reached = F.size(F.filter("_b", lambda x: x["L"] <= F.col("_v")))
    hits = F.transform(F.filter("_b", lambda x: (x["L"] <= F.col("_v")) & (x["U"] >= F.col("_v"))),
                       lambda x: F.struct(x["pi"].alias("pi"), F.col("_v").alias("_kv")))
    none = F.lit(None).cast(df.schema[value].dataType)
    e = j.select(*group, F.explode(F.concat(F.array(F.struct((-1 - reached).alias("pi"), none.alias("_kv"))), hits)).alias("_e"))
    counts = stage(e.groupBy(*group, "_e.pi", "_e._kv").agg(F.count(F.lit(1)).alias("_c")), "quantile_counts")
    # rank of a bracket's lower end among its group's: rows that reach fewer lie below
    ends = bounds.select(*group, "pi", F.rank().over(Window.partitionBy(*group).orderBy("L")).alias("_first"))
    under = counts.where("pi < 0").select(*group, (-1 - F.col("pi")).alias("_reached"), "_c")
    below = (ends.join(under, group).where(F.col("_reached") < F.col("_first"))
             .groupBy(*group, "pi").agg(F.sum("_c").alias("_c")))
    c = (counts.where("pi >= 0").select(*group, "pi", "_kv", "_c")
         .unionByName(below.select(*group, "pi", none.alias("_kv"), "_c")))
    w = (Window.partitionBy(*group, "pi").orderBy(F.col("_kv").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, 0))
    r = (c.withColumn("_cum", F.sum("_c").over(w))
         .join(bounds.select(*group, "pi", "_lo", "_hi"), group + ["pi"]))
    inside = F.col("_kv").isNotNull()
    return r.groupBy(*group, "pi").agg(
        F.min(F.when(inside & (F.col("_cum") > F.col("_lo")), F.col("_kv"))).alias("_xlo"),
        F.min(F.when(inside & (F.col("_cum") > F.col("_hi")), F.col("_kv"))).alias("_xhi"),
        F.coalesce(F.max(F.when(~inside, F.col("_c"))), F.lit(0)).alias("_below"),
        F.max("_cum").alias("_top"))


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float],
                    accuracy: int = 10000) -> DataFrame:
    """Exact quantiles with linear interpolation (``h = (n - 1) p``), as
    ``percentile_cont``; returns (group, p, quantile) per group and p.

    Two passes over the input: one aggregate (count, approximate bracket),
    one counting pass. The per-(group, p) tables between them are small and
    are written once (``stage``) so that no branch recomputes the input."""
    group = list(group)
    eps = 3.0 / accuracy
    lows = [max(0.0, p - eps) for p in probs]
    highs = [min(1.0, p + eps) for p in probs]
    v = F.col(value)
    st = df.where(v.isNotNull()).groupBy(*group).agg(
        F.count(v).alias("n"),
        F.percentile_approx(v, lows, accuracy).alias("_la"),
        F.percentile_approx(v, highs, accuracy).alias("_ha"),
        F.min(v).alias("_min"), F.max(v).alias("_max"))
    pr = F.array(*[F.lit(float(p)) for p in probs])
    st = st.select(*group, "n", "_min", "_max",
                   F.posexplode(F.arrays_zip(pr.alias("p"), F.col("_la").alias("L"),
                                             F.col("_ha").alias("U"))).alias("pi", "_z"))
    h = (F.col("n") - 1) * F.col("_z.p")
    bounds = stage(st.select(*group, "pi", "n", F.col("_z.p").alias("p"), "_min", "_max",
                             F.col("_z.L").alias("L"), F.col("_z.U").alias("U"),
                             F.floor(h).cast("long").alias("_lo"), F.ceil(h).cast("long").alias("_hi"),
                             (h - F.floor(h)).alias("_frac")), "quantile_bounds")
    res = stage(bounds.join(_quantile_pass(df, group, value, bounds), group + ["pi"], "left"),
                "quantile_pass")
    ok = (F.col("_below") <= F.col("_lo")) & (F.col("_top") > F.col("_hi"))
    cols = [*group, "p", "_xlo", "_xhi", "_frac"]
    both = res.where(ok).select(*cols)
    bad = res.where(~F.coalesce(ok, F.lit(False)))
    if not bad.isEmpty():
        # bracket missed (tiny groups only): exact pass over the full range
        full = bad.select(*group, "pi", "p", F.col("_min").alias("L"), F.col("_max").alias("U"),
                          "_lo", "_hi", "_frac")
        redo = _quantile_pass(df, group, value, full).join(full.select(*group, "pi", "p", "_frac"),
                                                           group + ["pi"])
        both = both.unionByName(redo.select(*cols))
    q = F.col("_xlo") + (F.col("_xhi") - F.col("_xlo")) * F.col("_frac")
    return both.select(*group, "p", F.when(F.col("_frac") == 0, F.col("_xlo")).otherwise(q).alias("quantile"))


def quantile_thresholds(df: DataFrame, group: Sequence[str], value: str, q: int,
                        accuracy: int = 10000) -> DataFrame:
    """The q-1 thresholds of a quantile scale, as one array per group."""
    probs = [k / q for k in range(1, q)]
    qs = exact_quantiles(df, group, value, probs, accuracy)
    return qs.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("p", "quantile"))).alias("_t")) \
        .select(*group, F.transform("_t", lambda s: s["quantile"]).alias("thresholds"))


def bisect_left(x: Column, sorted_list: Column) -> Column:
    """Insertion point before equal elements."""
    return F.size(F.filter(sorted_list, lambda t: t < x))


def bisect_right(x: Column, sorted_list: Column) -> Column:
    """Insertion point after equal elements."""
    return F.size(F.filter(sorted_list, lambda t: t <= x))


#: Number of thresholds <= x (a value equal to a threshold goes up).
threshold_index = bisect_right


def histogram(df: DataFrame, value: str, bins: int | None = None) -> DataFrame:
    """Equal-width histogram over the extent. Sturges' rule
    ``ceil(log2 n + 1)`` bins by default; thresholds ``lo + i * dx`` are
    computed as in the browser and a value goes to the last threshold not above
    it, the maximum to the last bin. Empty bins are kept."""
    v = F.col(value)
    st = df.where(v.isNotNull()).agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    nb = F.lit(bins) if bins else F.ceil(F.log2(F.col("n").cast("double")) + 1).cast("int")
    st = st.withColumn("m", nb).withColumn("dx", (F.col("hi") - F.col("lo")) / F.col("m"))
    # the statistics as one scalar subquery, bound once to a column
    one = st.select(F.struct("lo", "hi", "m", "dx").alias("s")).select("s").scalar()
    d = df.where(v.isNotNull()).select(v.alias("_v"), one.alias("_st"))
    lo, hi, m, dx = (F.col("_st." + c) for c in ("lo", "hi", "m", "dx"))
    x = F.col("_v")
    # bin = number of thresholds dx * i + lo (i = 1..m-1) not above x: an
    # arithmetic first guess, corrected by one against the thresholds
    # themselves so that float rounding matches the threshold comparison.
    b0 = F.least(m - 1, F.greatest(F.lit(0), F.coalesce(F.floor(F.try_divide(x - lo, dx)).cast("int"), m - 1)))  # no width: the last bin
    up = F.when((b0 < m - 1) & (dx * (b0 + 1) + lo <= x), b0 + 1)
    down = F.when((b0 > 0) & (dx * b0 + lo > x), b0 - 1)
    binned = (d.where((x >= lo) & (x <= hi))
              .select(F.when(m > 1, F.coalesce(up, down, b0)).otherwise(0).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("y")))
    spine = st.select(F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("bin"), "lo", "dx", "n")
    return (spine.join(binned, "bin", "left")
            .select("bin", (F.col("dx") * F.col("bin") + F.col("lo")).alias("x"), "dx",
                    F.coalesce("y", F.lit(0)).alias("y"),
                    (F.coalesce("y", F.lit(0)) / F.col("n")).alias("frequency")))


def nest_rollup(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Nested groups with key order (``sortKeys``) and a sum/count roll-up;
    ``key_order`` is the position of the inner key within its outer key."""
    keys = list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    w = Window.partitionBy(*keys[:-1]).orderBy(keys[-1])
    return g.withColumn("key_order", F.row_number().over(w).cast("int"))


def nest_entries(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """G15 nested form: one row per outer key with ``map(inner -> sum)``."""
    g = df.groupBy(outer, inner).agg(F.sum(value).alias("_s"))
    return g.groupBy(outer).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(inner, "_s"))))
                                .alias("values"))


def hierarchy_rollup(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Tree roll-up; a parent's value is the sum of its children.
    ``depth`` counts the levels present (0 = root)."""
    levels = list(levels)
    depth = sum(F.when(F.grouping(c) == 0, 1).otherwise(0) for c in levels)
    r = df.rollup(*levels).agg(F.sum(value).alias("value"), depth.cast("int").alias("depth"))
    return r.select(*levels, "depth", "value")


def flow_matrix(flows: DataFrame, src: str, dst: str, value: str) -> DataFrame:
    """Sums per (source, target), the reverse direction of each pair and the
    source's row total (chord layout input). One aggregate over unordered
    pairs gives both directions, so the input is read once."""
    a, b = F.least(src, dst), F.greatest(src, dst)
    pairs = (flows.groupBy(a.alias("_a"), b.alias("_b"))
             .agg(F.sum(F.when((F.col(src) == a) & (F.col(dst) == b), F.col(value))).alias("_ab"),
                  F.sum(F.when((F.col(src) == b) & (F.col(dst) == a), F.col(value))).alias("_ba")))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("_a").alias(src), F.col("_b").alias(dst), F.col("_ab").alias("value"),
                 F.col("_ba").alias("reverse_value")),
        F.struct(F.col("_b").alias(src), F.col("_a").alias(dst), F.col("_ba").alias("value"),
                 F.col("_ab").alias("reverse_value")))).alias("_r")).select("_r.*")
    m = both.where(F.col("value").isNotNull()).dropDuplicates([src, dst])
    return (m.withColumn("reverse_value", F.coalesce("reverse_value", F.lit(0.0)))
            .withColumn("src_total", F.sum("value").over(Window.partitionBy(src))))


def grid_occupancy(df: DataFrame, x: str, y: str, levels: int = 4) -> DataFrame:
    """Point counts per cell of a 2^L x 2^L grid over the extent, for
    L = 0..levels (quadtree occupancy by level). The points are counted once, at
    the finest level; a coarser cell is the sum of the four within it."""
    st = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    one = st.select(F.struct("x0", "x1", "y0", "y1").alias("s")).select("s").scalar()
    d = df.select(F.col(x).alias("_x"), F.col(y).alias("_y"), one.alias("_st"))
    x0, x1, y0, y1 = (F.col("_st." + c) for c in ("x0", "x1", "y0", "y1"))
    side = float(1 << levels)

    def cell(c, lo, hi):
        raw = F.floor(F.try_divide(c - lo, (hi - lo) / side))
        return F.when(hi == lo, 0).otherwise(F.least(F.lit(side) - 1, F.greatest(F.lit(0), raw))).cast("long")

    finest = d.groupBy(cell(F.col("_x"), x0, x1).alias("_cx"), cell(F.col("_y"), y0, y1).alias("_cy")).agg(F.count(F.lit(1)).alias("_n"))
    return (finest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
            .groupBy("level", F.expr(f"shiftright(_cx, {levels} - level)").alias("cx"), F.expr(f"shiftright(_cy, {levels} - level)").alias("cy"))
            .agg(F.sum("_n").alias("n")))


def polygon_measures(vertices: DataFrame, poly: str, order: str | Sequence[str], x: str, y: str) -> DataFrame:
    """Signed area (browser convention) and centroid of polygons given as
    vertex rows; the previous vertex of the first is the last (wrap-around)."""
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(poly).orderBy(*order)
    wall = Window.partitionBy(poly).orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                Window.unboundedFollowing)
    v = (vertices.withColumn("_px", F.coalesce(F.lag(x).over(w), F.last(x).over(wall)))
         .withColumn("_py", F.coalesce(F.lag(y).over(w), F.last(y).over(wall))))
    cross = F.col("_px") * F.col(y) - F.col(x) * F.col("_py")
    g = v.groupBy(poly).agg(
        F.count(F.lit(1)).alias("n_vertices"),
        (F.sum(F.col("_py") * F.col(x) - F.col("_px") * F.col(y)) * 0.5).alias("area"),
        F.sum((F.col("_px") + F.col(x)) * cross).alias("_cx"),
        F.sum((F.col("_py") + F.col(y)) * cross).alias("_cy"))
    k = F.lit(-1.0) / (F.col("area") * 6)
    return g.select(poly, "n_vertices", "area",
                    F.when(F.col("area") != 0, F.col("_cx") * k).alias("cx"),
                    F.when(F.col("area") != 0, F.col("_cy") * k).alias("cy"))


# ---- G19: convex hull per group (two phases) --------------------------------

def _hull(xy: np.ndarray) -> np.ndarray:
    """Counter-clockwise hull vertices, from the lowest x on (fewer than 3
    distinct points, or all on a line: empty). Points inside the hull of the
    extremes in eight directions are set aside first, all at once."""
    pts = np.unique(xy, axis=0)
    if len(pts) < 3:
        return np.zeros((0, 2))
    angles = np.arange(8) * (np.pi / 4)
    rim = np.unique(np.argmax(pts @ np.stack([np.cos(angles), np.sin(angles)]), axis=0))
    if len(rim) >= 3 and len(pts) > 64:
        middle = pts[rim].mean(0)
        ring = pts[rim][np.argsort(np.arctan2(*(pts[rim] - middle).T[::-1]))]
        after = np.roll(ring, -1, axis=0) - ring
        inside = np.ones(len(pts), bool)
        for (px, py), (dx, dy) in zip(ring, after):
            inside &= dx * (pts[:, 1] - py) - dy * (pts[:, 0] - px) > 1e-9 * max(1.0, abs(dx), abs(dy))
        inside[rim] = False
        pts = pts[~inside]

    def chain(points: list) -> list:
        out: list = []
        for x, y in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (y - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (x - out[-2][0]):
                out.pop()
            out.append((x, y))
        return out[:-1]

    ordered = pts.tolist()  # sorted by x, then y
    ring = np.array(chain(ordered) + chain(ordered[::-1]))
    return ring if len(ring) >= 3 else np.zeros((0, 2))


def convex_hulls(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Hull vertices per group, in order. Phase 1 keeps only each
    partition's local hull points per group (``mapInPandas``); phase 2 builds
    the hull of those few survivors per group (``applyInPandas``)."""
    gtype = df.schema[group].dataType.simpleString()
    local_schema = f"`{group}` {gtype}, x double, y double"

    def local(batches):
        held: dict = {}  # each group's hull so far
        for batch in batches:
            for g, sub in batch[[group, x, y]].groupby(group, sort=False, dropna=False):
                g = None if pd.isna(g) else g
                xy = sub[[x, y]].to_numpy(dtype=float)
                xy = np.vstack([held[g], xy]) if g in held else xy
                h = _hull(xy)
                held[g] = h if len(h) else np.unique(xy, axis=0)[[0, -1]] if len(xy) > 1 else xy  # on a line: its ends
        for g, keep in held.items():
            yield pd.DataFrame({group: [g] * len(keep), "x": keep[:, 0], "y": keep[:, 1]})

    survivors = df.select(group, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)) \
        .where(F.col(x).isNotNull() & F.col(y).isNotNull()).mapInPandas(local, local_schema)

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        h = _hull(pdf[["x", "y"]].to_numpy(dtype=float))
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(h), "vertex": np.arange(len(h), dtype="int32"),
                             "x": h[:, 0] if len(h) else [], "y": h[:, 1] if len(h) else []})

    return survivors.groupBy(group).applyInPandas(final, f"`{group}` {gtype}, vertex int, x double, y double")


def _spread_bits(x: Column) -> Column:
    """A number below 2 ** 32 with a zero bit before each of its bits."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def quadtree_leaves(points: DataFrame, group: Sequence[str], x: str, y: str, depth: int = 24, chunk_levels: int = 8) -> DataFrame:
    """The leaves (group, depth, cx, cy, n) of each group's adaptive quadtree:
    the largest cells, halved in both directions level by level from the square over
    the group's extent, that hold a single place; n counts the points there.
    Places are told apart to ``depth`` levels, where cells may hold several.

    A point's way down is its Morton code (the bits of its cell numbers by
    turns), and its leaf ends one level below the longest way it shares with a
    neighbour in code order. Neighbours come from the chunked ``previous_row``,
    up and down, with a chunk for each cell of level ``chunk_levels``, so no task
    sorts a group. Points with a null or NaN coordinate take no part."""
    from .series import previous_row

    group, size = list(group), 1 << depth
    rows = points.select(*group, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where("_x = _x AND _y = _y AND NOT isnan(_x) AND NOT isnan(_y)")
    extent = rows.groupBy(*group).agg(F.min("_x").alias("_x0"), F.min("_y").alias("_y0"),
                                      F.greatest(F.max("_x") - F.min("_x"), F.max("_y") - F.min("_y")).alias("_span"))
    cell = lambda v, low: F.when(F.col("_span") > 0, F.least(F.lit(size - 1), F.floor((F.col(v) - F.col(low)) / F.col("_span") * size))).otherwise(0).cast("long")
    keyed = rows.join(extent, group).select(*group, cell("_x", "_x0").alias("_cx"), cell("_y", "_y0").alias("_cy"))
    places = keyed.groupBy(*group, "_cx", "_cy").agg(F.count(F.lit(1)).alias("n"))
    places = places.withColumn("_code", _spread_bits(F.col("_cx")).bitwiseOR(F.shiftleft(_spread_bits(F.col("_cy")), 1)))
    places = stage(places.withColumn("_back", -F.col("_code")), "quadtree-places")
    chunk = 1 << 2 * (depth - min(chunk_levels, depth))
    near = previous_row(places, group, "_code", [], ["_code"], prefix="_low", chunk_seconds=chunk)
    near = previous_row(near, group, "_back", [], ["_code"], prefix="_high", chunk_seconds=chunk)
    # levels shared with a neighbour: those above the highest bit that differs
    shared = lambda other: depth - F.floor((F.length(F.bin(F.col("_code").bitwiseXOR(F.col(other)))) + 1) / 2)
    level = F.coalesce(F.greatest(shared("_low_code"), shared("_high_code")) + 1, F.lit(0)).cast("int")
    up = lambda c: F.call_function("shiftright", F.col(c), F.lit(depth) - F.col("depth"))
    return near.withColumn("depth", level).select(*group, "depth", up("_cx").alias("cx"), up("_cy").alias("cy"), "n")
