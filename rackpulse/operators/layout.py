"""Ordered and stacked layouts over grouped series.

Every window is partitioned by a group key over pre-aggregated rows (one row
per x and series, per parent, per slice), so no window sees raw data of a
whole table. Looking forward is done by ordering descending with a running
frame, which Spark evaluates in one pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TAU = 2 * math.pi


def adjacent_pairs(df: DataFrame, group: Sequence[str], order: str | Sequence[str], value: str,
                   chunk: int = 1 << 30) -> DataFrame:
    """(a, b) for consecutive elements of each group; the last has no pair.
    ``order[0]`` must be numeric: it also cuts a group into chunks of
    ``chunk`` units (see ``series.previous_row``)."""
    from .series import previous_row

    order = [order] if isinstance(order, str) else list(order)
    p = previous_row(df.select(*group, *order, value), group, order[0], order[1:], [order[0], value],
                     chunk_seconds=chunk)
    return (p.where(F.col("prev_" + value).isNotNull())
            .select(*group, F.col("prev_" + order[0]).alias(order[0]),
                    F.col("prev_" + value).alias("a"), F.col(value).alias("b")))


def stack(values: DataFrame, x: str, series: str, y: str, offset: str = "zero",
          order: str = "default") -> DataFrame:
    """Stacked series. ``values`` has one row per (x, series).

    offset ``zero``: baseline = sum of earlier series at x; ``expand``: values
    as shares of the x total (1/n each when the total is 0); ``silhouette``:
    centred on the largest total. order ``default`` (series key) or
    ``reverse``."""
    so = F.col(series).desc() if order == "reverse" else F.col(series).asc()
    run = Window.partitionBy(x).orderBy(so).rowsBetween(Window.unboundedPreceding, -1)
    allx = Window.partitionBy(x)
    v = values.withColumn("_tot", F.sum(y).over(allx)).withColumn("_cnt", F.count(F.lit(1)).over(allx))
    if offset == "expand":
        share = F.when(F.col("_tot") == 0, F.lit(1.0) / F.col("_cnt")).otherwise(F.col(y) / F.col("_tot"))
        v = v.withColumn("_y", share)
        base = F.lit(0.0)
    elif offset == "silhouette":
        v = v.withColumn("_y", F.col(y).cast("double"))
        top = values.groupBy(x).agg(F.sum(y).alias("_t")).select(F.max("_t")).scalar()
        base = (top - F.col("_tot")) / 2
    else:
        v = v.withColumn("_y", F.col(y).cast("double"))
        base = F.lit(0.0)
    return v.select(x, series, F.col("_y").alias("y"),
                    (base + F.coalesce(F.sum("_y").over(run), F.lit(0.0))).alias("y0"))


def pie(values: DataFrame, key: str, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Angles of a pie, largest slice first (ties by key): start and end
    angle are cumulative shares times 2*pi."""
    group = list(group)
    o = Window.partitionBy(*group).orderBy(F.col(value).desc(), F.col(key)) \
        .rowsBetween(Window.unboundedPreceding, -1) if group else \
        Window.orderBy(F.col(value).desc(), F.col(key)).rowsBetween(Window.unboundedPreceding, -1)
    tot = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    k = F.coalesce(F.try_divide(F.lit(TAU), F.sum(value).over(tot)), F.lit(0.0))  # a total of 0: empty slices
    start = F.coalesce(F.sum(value).over(o), F.lit(0.0)) * k
    return values.select(*group, key, value, start.alias("start_angle"),
                         (start + F.col(value) * k).alias("end_angle"))


def nested_intervals(children: DataFrame, parent: str, child: str, value: str,
                     parent_x0: str = "px0", parent_dx: str = "pdx") -> DataFrame:
    """Each child's interval inside its parent's, by share of value
    (siblings largest first, as the partition layout sorts them)."""
    w = Window.partitionBy(parent).orderBy(F.col(value).desc(), F.col(child)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    tot = Window.partitionBy(parent)
    total = F.sum(value).over(tot)  # 0: every child is empty and lies at its parent's start
    share_before = F.coalesce(F.try_divide(F.coalesce(F.sum(value).over(w), F.lit(0.0)), total), F.lit(0.0))
    share = F.coalesce(F.try_divide(F.col(value), total), F.lit(0.0))
    return children.select(parent, child, value,
                           (F.col(parent_x0) + share_before * F.col(parent_dx)).alias("x0"),
                           (share * F.col(parent_dx)).alias("dx"))


def gap_interpolate(spine_values: DataFrame, group: Sequence[str], t: str, value: str,
                    chunk_seconds: int = 1 << 30) -> DataFrame:
    """Fill null values on a time spine linearly between the previous and
    next known values (ends stay null); ``t`` is unique per group.

    Both neighbours come from the chunked ``series.forward_fill``: the next
    known value in ascending time, the previous one as the next known value
    in ascending ``-t``. A group's spine is thus cut into chunks of
    ``chunk_seconds`` rather than held by one task."""
    from .series import forward_fill

    group = list(group)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(t).alias("t"), F.col(value).alias("v")))
    d = spine_values.select(*group, t, value, known.alias("_k"), F.lit(0).alias("_tie"),
                            (-F.col(t)).alias("_neg_t"))
    d = forward_fill(d, group, t, "_tie", ["_k"], prefix="_n", chunk_seconds=chunk_seconds)
    d = forward_fill(d, group, "_neg_t", "_tie", ["_k"], prefix="_p", chunk_seconds=chunk_seconds)
    p_t, p_v, n_t, n_v = F.col("_p_k.t"), F.col("_p_k.v"), F.col("_n_k.t"), F.col("_n_k.v")
    frac = (F.col(t) - p_t).cast("double") / (n_t - p_t).cast("double")
    filled = F.when(F.col(value).isNotNull(), F.col(value)) \
        .when(n_t == p_t, p_v).otherwise(p_v + (n_v - p_v) * frac)
    return d.select(*group, t, F.col(value).alias("raw"), filled.alias("filled"))


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """angle in radians between two points given in radians."""
    dl = lon2 - lon1
    a = F.cos(lat2) * F.sin(dl)
    b = F.cos(lat1) * F.sin(lat2) - F.sin(lat1) * F.cos(lat2) * F.cos(dl)
    c = F.sin(lat1) * F.sin(lat2) + F.cos(lat1) * F.cos(lat2) * F.cos(dl)
    return F.atan2(F.sqrt(a * a + b * b), c)


def path_length(points: DataFrame, group: Sequence[str], t: str, tie: Sequence[str], lon: str, lat: str,
                chunk_seconds: int = 30 * 86400) -> DataFrame:
    """Great-circle length (radians) of each group's path ordered by
    ``(t, tie...)`` (``t`` numeric, e.g. epoch seconds). Predecessors come
    from the chunked ``previous_row``, so one very long path is still split
    over many tasks; the segment lengths are then summed (partial aggregate)."""
    from .series import previous_row

    p = previous_row(points.select(*group, t, *tie, lon, lat), group, t, tie, [lon, lat],
                     chunk_seconds=chunk_seconds)
    seg = great_circle(F.col("prev_" + lon), F.col("prev_" + lat), F.col(lon), F.col(lat))
    return (p.select(*group, seg.alias("_s"))
            .groupBy(*group).agg(F.coalesce(F.sum("_s"), F.lit(0.0)).alias("length"),
                                 F.count(F.lit(1)).alias("n_points")))


def stack_wiggle(values: DataFrame, x: str, series: str, y: str, chunk: int = 1 << 30) -> DataFrame:
    """W6 ``wiggle`` offset (streamgraph baseline that minimises weighted
    change in slope), then series stacked on it in key order.

    With series i = 0..n-1 and x positions j: s1_j = sum_i y_ij; s3_ij =
    dy_ij / (2 dx_j) + sum_{k<i} dy_kj / dx_j; s2_j = sum_i s3_ij y_ij; the
    baseline o_j = o_{j-1} - s2_j / s1_j * dx_j (0 when s1_j = 0), shifted so
    that its minimum is 0. ``values`` must hold every (x, series) pair;
    ``x`` is numeric and ``chunk`` (in x units) cuts the running baseline."""
    from .series import running_sum

    bys = Window.partitionBy(series).orderBy(x)
    byx_before = Window.partitionBy(x).orderBy(series).rowsBetween(Window.unboundedPreceding, -1)
    v = (values.withColumn("_dy", F.col(y) - F.lag(y).over(bys))
         .withColumn("_dx", (F.col(x) - F.lag(x).over(bys)).cast("double")))
    v = v.withColumn("_s3", F.col("_dy") / (2 * F.col("_dx"))
                     + F.coalesce(F.sum(F.col("_dy") / F.col("_dx")).over(byx_before), F.lit(0.0)))
    per_x = v.groupBy(x).agg(F.sum(y).alias("_s1"), F.sum(F.col("_s3") * F.col(y)).alias("_s2"),
                             F.max("_dx").alias("_dx"))
    # one row per x position: cumulative baseline over x (chunked running
    # sum, no single-task window), shifted by its minimum (a scalar subquery)
    step = F.when(F.col("_dx").isNull(), F.lit(0.0)).when(F.col("_s1") == 0, F.lit(0.0)) \
        .otherwise(F.col("_s2") / F.col("_s1") * F.col("_dx"))
    o = running_sum(per_x.select(x, (-step).alias("_step")), [], x, "_step", "_o", chunk_seconds=chunk)
    base = o.select(x, (F.col("_o") - o.select(F.min("_o")).scalar()).alias("_base"))
    below = Window.partitionBy(x).orderBy(series).rowsBetween(Window.unboundedPreceding, -1)
    return (values.join(base, x)
            .select(x, series, F.col(y).cast("double").alias("y"),
                    (F.col("_base") + F.coalesce(F.sum(y).over(below), F.lit(0.0))).alias("y0")))


def inside_out_order(values: DataFrame, x: str, series: str, y: str) -> DataFrame:
    """W6 ``inside-out`` series order. Series come in the order of the x of
    their (first) maximum. Each goes to the lighter of two sides, to the lower
    one while they weigh the same; seen from the middle, the lower side runs
    downwards and the upper one upwards.

    Only the balance between the sides matters for where a series goes, so it
    is folded over the series' totals (one row per series in a chart) with an
    SQL ``aggregate``; places are then counted per side with windows."""
    peak = F.max_by(F.col(x), F.struct(F.col(y), -F.col(x)))
    totals = values.groupBy(series).agg(F.sum(y).cast("double").alias("w"), peak.alias("at"))
    turns = totals.agg(F.array_sort(F.collect_list(F.struct("at", F.col(series).alias("s"), "w"))).alias("turns"))
    start = F.struct(F.lit(0.0).alias("lean"), F.array().cast("array<boolean>").alias("up"))

    def place(so_far, turn):
        up = so_far["lean"] < 0
        return F.struct((so_far["lean"] + F.when(up, turn["w"]).otherwise(-turn["w"])).alias("lean"),
                        F.concat(so_far["up"], F.array(up)).alias("up"))

    sides = turns.select(F.posexplode(F.arrays_zip(F.transform("turns", lambda t: t["s"]).alias("s"),
                                                   F.aggregate("turns", start, place, lambda done: done["up"]).alias("up"))))
    sides = sides.select("pos", F.col("col.s").alias(series), F.col("col.up").alias("up"))
    outwards = F.row_number().over(Window.partitionBy("up").orderBy("pos"))
    lower = F.count_if(~F.col("up")).over(Window.partitionBy())  # over one row per series
    place_of = F.when(F.col("up"), lower + outwards - 1).otherwise(lower - outwards)
    return sides.select(series, place_of.cast("int").alias("position"))


def densify(values: DataFrame, x: str, series: str, y: str) -> DataFrame:
    """Every (x, series) pair, missing values as 0: the pairs are laid out from
    the distinct x and the chart's series, and the sums joined to them."""
    every = values.agg(F.collect_set(series).alias("s")).select("s").scalar()
    spine = values.select(x).distinct().select(x, F.explode(every).alias(series))
    sums = values.groupBy(x, series).agg(F.sum(y).alias(y))
    return spine.join(sums, [x, series], "left").select(x, series, F.coalesce(y, F.lit(0)).alias(y))
