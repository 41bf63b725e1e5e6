"""Data half of the 2-D views: dimension choice, scales, extents, ticks, count
tables and Voronoi cells (P9-P13, G8-G10, J8-J10).

Scales need the extent of a group; it is computed by one aggregate and joined
back on the group key (one row per group), never by an unpartitioned window.
Cell polygons are the only part in Python: one pandas call per group over its
k centres, with groups spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scales import linear
from .cluster import nearest_center

# The view's dimension list (dropdown order) and canvas size.
DIMENSIONS = ["filereads", "filewrites", "CPU", "diskIOBW", "net_bytes"]
WIDTH, HEIGHT = 600, 450
PALETTE_SIZE = 20


def dim_pairs(points: DataFrame, ids: Sequence[str], dims: Sequence[str] = DIMENSIONS,
              pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The chosen (x, y) pairs of dimensions for every point; by default
    every ordered pair of distinct ones."""
    pairs = pairs or [(x, y) for x in dims for y in dims if x != y]
    arr = F.array(*[F.struct(F.lit(x).alias("xdim"), F.lit(y).alias("ydim"),
                             F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
                    for x, y in pairs])
    return points.select(*ids, F.explode(arr).alias("_p")).select(*ids, "_p.*")


def clean_nan(c: Column) -> Column:
    """NaN -> null, so min/max skip it as the browser's extent does."""
    return F.when(~F.isnan(c), c)


def dim_extent(points: DataFrame, group: Sequence[str], dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Min and max per group and dimension, skipping null and NaN."""
    aggs = []
    for d in dims:
        aggs += [F.min(clean_nan(F.col(d))).alias(f"lo_{d}"), F.max(clean_nan(F.col(d))).alias(f"hi_{d}")]
    wide = points.groupBy(*group).agg(*aggs)
    arr = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(f"lo_{d}").alias("lo"),
                             F.col(f"hi_{d}").alias("hi")) for d in dims])
    return wide.select(*group, F.explode(arr).alias("_e")).select(*group, "_e.*")


def scale_view(points: DataFrame, group: Sequence[str], xdim: str, ydim: str,
               width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """P10 for a view: pixel x in [0, width], y flipped to [height, 0], with
    the domain of each group's points."""
    group = list(group)
    ext = points.groupBy(*group).agg(
        F.min(clean_nan(F.col(xdim))).alias("_xlo"), F.max(clean_nan(F.col(xdim))).alias("_xhi"),
        F.min(clean_nan(F.col(ydim))).alias("_ylo"), F.max(clean_nan(F.col(ydim))).alias("_yhi"))
    j = points.join(ext, group)
    return (j.withColumn("px", linear(F.col(xdim), F.col("_xlo"), F.col("_xhi"), 0, width))
            .withColumn("py", linear(F.col(ydim), F.col("_ylo"), F.col("_yhi"), height, 0))
            .drop("_xlo", "_xhi", "_ylo", "_yhi"))


def scale_with_extent(df: DataFrame, ext: DataFrame, group: Sequence[str], xdim: str, ydim: str,
                      width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """Apply another frame's extent (``_xlo``...) to ``df`` (centres use the points' scales)."""
    j = df.join(ext, list(group))
    return (j.withColumn("px", linear(F.col(xdim), F.col("_xlo"), F.col("_xhi"), 0, width))
            .withColumn("py", linear(F.col(ydim), F.col("_ylo"), F.col("_yhi"), height, 0))
            .drop("_xlo", "_xhi", "_ylo", "_yhi"))


def view_extent(points: DataFrame, group: Sequence[str], xdim: str, ydim: str) -> DataFrame:
    return points.groupBy(*group).agg(
        F.min(clean_nan(F.col(xdim))).alias("_xlo"), F.max(clean_nan(F.col(xdim))).alias("_xhi"),
        F.min(clean_nan(F.col(ydim))).alias("_ylo"), F.max(clean_nan(F.col(ydim))).alias("_yhi"))


def quantize(x: Column, lo: Column, hi: Column, n: int) -> Column:
    """N equal buckets over [lo, hi], clamped; null for a zero-width domain."""
    b = F.floor(F.lit(n) * (x - lo) / (hi - lo))
    return F.when(hi != lo, F.greatest(F.lit(0), F.least(F.lit(n - 1), b)).cast("int"))


def ordinal_codes(df: DataFrame, value: str, order: str, palette: int = PALETTE_SIZE) -> DataFrame:
    """Code of each distinct value by first appearance, and its palette
    slot ``code mod palette``. The window runs over the distinct values only."""
    from ..session import stage
    from .series import ordered_index
    # one pass over the input; the distinct values (a short table) are
    # written once and numbered from there
    firsts = stage(df.groupBy(value).agg(F.min(order).alias("first_pos")), "ordinal_firsts") \
        .withColumn("_all", F.lit(0))
    # chunked numbering: no task holds more than one range of positions
    ranked = ordered_index(firsts, ["_all"], "first_pos", "_rn", chunk_seconds=1 << 20,
                           tiebreak=[value])
    return (ranked.withColumn("code", (F.col("_rn") - 1).cast("int"))
            .withColumn("slot", F.pmod("code", F.lit(palette)).cast("int"))
            .drop("_rn", "_all"))


def tick_step(lo: Column, hi: Column, m: int = 10) -> Column:
    """Tick step 1, 2 or 5 x 10^k giving about ``m`` ticks over [lo, hi]."""
    # The errors 0.15, 0.35 and 0.75 up to which a step is taken tenfold, fivefold or twice.
    span = hi - lo
    step = F.pow(F.lit(10.0), F.floor(F.log10(span / F.lit(m))))
    err = F.lit(m) / span * step
    return (F.when(err <= 0.15, step * 10).when(err <= 0.35, step * 5)
            .when(err <= 0.75, step * 2).otherwise(step))


def nice_ticks(ext: DataFrame, group: Sequence[str], m: int = 10) -> DataFrame:
    """Ticks ``i * step`` for i from ceil(lo/step) to floor(hi/step), and
    the domain widened to whole steps (``nice``). ``ext`` has (group, lo, hi)."""
    s = ext.where(F.col("hi") > F.col("lo")).withColumn("step", tick_step(F.col("lo"), F.col("hi"), m))
    s = (s.withColumn("_i0", F.ceil(F.col("lo") / F.col("step")).cast("long"))
         .withColumn("_i1", F.floor(F.col("hi") / F.col("step")).cast("long"))
         .withColumn("nice_lo", F.floor(F.col("lo") / F.col("step")) * F.col("step"))
         .withColumn("nice_hi", F.ceil(F.col("hi") / F.col("step")) * F.col("step")))
    return (s.withColumn("i", F.explode(F.sequence("_i0", "_i1")))
            .select(*group, "step", "nice_lo", "nice_hi", "i", (F.col("i") * F.col("step")).alias("tick")))


def voronoi_assign(points: DataFrame, centers: DataFrame, group: Sequence[str], xdim: str, ydim: str,
                   width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """The cell (nearest centre) of each point in the scaled 2-D view, not
    in all dimensions. Centres are scaled with the points' domain."""
    group = list(group)
    ext = view_extent(points, group, xdim, ydim)
    p = scale_with_extent(points, ext, group, xdim, ydim, width, height)
    c = scale_with_extent(centers, ext, group, xdim, ydim, width, height)
    a = nearest_center(p.withColumnRenamed("px", "_vx").withColumnRenamed("py", "_vy"),
                       c.select(*group, "cluster_id", F.col("px").alias("_vx"), F.col("py").alias("_vy")),
                       group, ["_vx", "_vy"])
    return a.withColumnRenamed("cluster_id", "cell").withColumnRenamed("_vx", "px") \
        .withColumnRenamed("_vy", "py")


def cell_counts(assigned: DataFrame, group: Sequence[str], cell: str = "cell") -> DataFrame:
    """Points and share per cell (share within the group)."""
    group = list(group)
    c = assigned.groupBy(*group, cell).agg(F.count(F.lit(1)).alias("n_points"))
    tot = assigned.groupBy(*group).agg(F.count(F.lit(1)).alias("_tot"))
    return c.join(tot, group).withColumn("share", F.col("n_points") / F.col("_tot")).drop("_tot")


def count_2d(df: DataFrame, x: str, y: str, x_bin: float | None = None, y_bin: float | None = None,
             weight: str | None = None) -> DataFrame:
    """Counts per (x, y) cell, optional bin widths, optional weights."""
    xc = F.floor(F.col(x) / x_bin) * x_bin if x_bin else F.col(x)
    yc = F.floor(F.col(y) / y_bin) * y_bin if y_bin else F.col(y)
    agg = F.sum(weight).alias("n") if weight else F.count(F.lit(1)).alias("n")
    return df.groupBy(xc.alias(x), yc.alias(y)).agg(agg)


# ---- J9 / J10: cell polygons and neighbours (per group, k centres) ----------

def _cut(poly: np.ndarray, edges: np.ndarray, a: np.ndarray, b: float, label: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut a convex polygon to the half plane a.x <= b. ``edges[i]`` names the
    edge from vertex i to the next; the new edge is named ``label``."""
    over = poly @ a - b
    inside = over <= 0
    if inside.all():
        return poly, edges
    if not inside.any():
        return poly[:0], edges[:0]
    n = len(poly)
    enter = int(np.nonzero(~inside & np.roll(inside, -1))[0][0])   # last vertex outside
    poly, edges, over, inside = (np.roll(x, -enter, axis=0) for x in (poly, edges, over, inside))
    kept = int(inside.sum())                                       # vertices 1 .. kept stay

    def crossing(i: int, j: int) -> np.ndarray:
        t = over[i] / (over[i] - over[j])
        return poly[i] + t * (poly[j] - poly[i])

    first, last = crossing(0, 1), crossing(kept, (kept + 1) % n)
    return np.vstack([first, poly[1:kept + 1], last]), np.r_[edges[0], edges[1:kept + 1], label]


def _cell(i: int, pts: np.ndarray, box: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Voronoi cell of centre i inside a convex box and the neighbour behind
    each edge (-1: the box), in coordinates relative to the centre.

    Centres cut the cell nearest first; once half the distance exceeds the
    cell's radius, no later one can reach it."""
    away = pts - pts[i]
    far = np.einsum("ij,ij->i", away, away)
    poly, edges = box - pts[i], np.full(len(box), -1)
    for j in np.argsort(far, kind="stable"):
        if far[j] == 0:
            continue
        if len(poly) == 0 or far[j] > 4 * (poly * poly).sum(1).max():
            break
        poly, edges = _cut(poly, edges, away[j], far[j] / 2, int(j))
    return poly, edges


def _centres(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(ids, positions) in the order of id; of coincident centres the first."""
    pdf = pdf.sort_values("cluster_id", kind="stable").drop_duplicates(["px", "py"])
    return pdf["cluster_id"].to_numpy(), pdf[["px", "py"]].to_numpy(dtype=float)


def cell_polygons(centers: pd.DataFrame, width: float, height: float) -> list[tuple[int, list]]:
    """Voronoi cell of each centre clipped to [0, width] x [0, height], as
    (cluster_id, [(x, y)...]). Of coincident centres only the first keeps a cell."""
    ids, pts = _centres(centers)
    box = np.array([[0.0, 0.0], [width, 0.0], [width, height], [0.0, height]])
    return [(int(ids[i]), [(float(x), float(y)) for x, y in _cell(i, pts, box)[0] + pts[i]]) for i in range(len(pts))]


def voronoi_cells(scaled_centers: DataFrame, group: Sequence[str], width: float = WIDTH,
                  height: float = HEIGHT) -> DataFrame:
    """Cell polygon vertices per group and centre (one row per vertex).

    ``scaled_centers`` has (group, cluster_id, px, py). Each group's k centres
    go to one pandas call; groups run in parallel."""
    group = list(group)
    schema_fields = scaled_centers.select(*group).schema
    gs = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_fields)
    schema = f"{gs}, cluster_id int, vertex int, x double, y double"

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        gvals = [pdf[g].iloc[0] for g in group]
        for cid, poly in cell_polygons(pdf, width, height):
            for v, (x, y) in enumerate(poly):
                rows.append((*gvals, cid, v, x, y))
        return pd.DataFrame(rows, columns=group + ["cluster_id", "vertex", "x", "y"])

    return scaled_centers.select(*group, "cluster_id", "px", "py").groupBy(*group).applyInPandas(fn, schema)


def delaunay_links(pdf: pd.DataFrame) -> list[tuple[int, int]]:
    """Pairs of centres whose (unclipped) cells share an edge.

    The box lies so far out that every ray of the diagram crosses it. An edge
    counts if it is longer than rounding allows at its distance."""
    ids, pts = _centres(pdf)
    if len(pts) < 2:
        return []
    low, high = pts.min(0), pts.max(0)
    reach = 1e5 * float((high - low).max())
    (x0, y0), (x1, y1) = low - reach, high + reach
    box = np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1]])
    pairs = set()
    for i in range(len(pts)):
        poly, edges = _cell(i, pts, box)
        ends = np.roll(poly, -1, axis=0)
        length = np.hypot(*(ends - poly).T)
        least = 1e-9 * np.maximum(np.hypot(*poly.T), np.hypot(*ends.T))
        for j in edges[(edges >= 0) & (length > least)]:
            pairs.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return sorted(pairs)


def delaunay_triangles(pdf: pd.DataFrame) -> list[tuple[int, int, int]]:
    """Triangles of mutually linked centres whose circumcircle holds no other
    centre (the Delaunay triangles)."""
    links = delaunay_links(pdf)
    adj: dict[int, set[int]] = {}
    for a, b in links:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    pos = {int(c): (float(x), float(y)) for c, x, y in zip(pdf["cluster_id"], pdf["px"], pdf["py"])}
    out = []
    for a, b in links:
        for c in sorted(adj[a] & adj[b]):
            if c <= b:
                continue
            (ax, ay), (bx, by), (cx, cy) = pos[a], pos[b], pos[c]
            d = 2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by))
            if d == 0:
                continue
            ux = ((ax * ax + ay * ay) * (by - cy) + (bx * bx + by * by) * (cy - ay) + (cx * cx + cy * cy) * (ay - by)) / d
            uy = ((ax * ax + ay * ay) * (cx - bx) + (bx * bx + by * by) * (ax - cx) + (cx * cx + cy * cy) * (bx - ax)) / d
            r2 = (ax - ux) ** 2 + (ay - uy) ** 2
            if all((px - ux) ** 2 + (py - uy) ** 2 >= r2 * (1 - 1e-9)
                   for k, (px, py) in pos.items() if k not in (a, b, c)):
                out.append((a, b, c))
    return out


def voronoi_links(scaled_centers: DataFrame, group: Sequence[str]) -> DataFrame:
    """Neighbouring centres (Delaunay links), one row per pair (a < b)."""
    group = list(group)
    gs = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scaled_centers.select(*group).schema)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        gvals = [pdf[g].iloc[0] for g in group]
        return pd.DataFrame([(*gvals, a, b) for a, b in delaunay_links(pdf)], columns=group + ["a", "b"])

    return scaled_centers.select(*group, "cluster_id", "px", "py").groupBy(*group) \
        .applyInPandas(fn, f"{gs}, a int, b int")


def voronoi_triangles(scaled_centers: DataFrame, group: Sequence[str]) -> DataFrame:
    """Delaunay triangles, one row per triangle (a < b < c)."""
    group = list(group)
    gs = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scaled_centers.select(*group).schema)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        gvals = [pdf[g].iloc[0] for g in group]
        return pd.DataFrame([(*gvals, *t) for t in delaunay_triangles(pdf)], columns=group + ["a", "b", "c"])

    return scaled_centers.select(*group, "cluster_id", "px", "py").groupBy(*group) \
        .applyInPandas(fn, f"{gs}, a int, b int, c int")
