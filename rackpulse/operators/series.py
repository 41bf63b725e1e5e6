"""Ordered-series primitives that stay parallel when one series is huge.

An ordered window over a whole key group (say one server-day) runs the group
in a single task, and ``rowsBetween(currentRow, unboundedFollowing)`` frames
are quadratic in Spark. These helpers therefore

* split every key group into time chunks (``floor(t / chunk_seconds)``) and run
  the ordered work per ``(keys, chunk)``;
* look forward by ordering *descending* with a running frame
  (``unboundedPreceding .. currentRow``), which Spark evaluates in one pass;
* carry what crosses a chunk border through a per-chunk summary, which has at
  most ``span / chunk_seconds`` rows per key, so a hot key costs one more
  small aggregate, not one long task.

Keys must be non-null columns (callers give site-wide series a key of their
own rather than a null server).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_SECONDS = 3600

_CH = "_chunk"


def _chunk(t: Column, chunk_seconds: int) -> Column:
    return F.floor(t / F.lit(chunk_seconds)).cast("long")


def ordered_index(df: DataFrame, keys: Sequence[str], t: str, out: str = "rn",
                  chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """1-based ``row_number`` over ``keys`` ordered by ``t`` (then ``tiebreak``).

    Computed as a local row number per ``(keys, chunk)`` plus the count of all
    earlier chunks of the key, so no task holds more than one chunk.
    """
    keys = list(keys)
    d = df.withColumn(_CH, _chunk(F.col(t), chunk_seconds))
    order = [F.col(t)] + [F.col(c) for c in tiebreak]
    local = d.withColumn("_lrn", F.row_number().over(
        Window.partitionBy(*keys, _CH).orderBy(*order)))
    # counts per chunk: a partial aggregate, so only one row per chunk and
    # task crosses the network
    counts = d.groupBy(*keys, _CH).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(_CH).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, _CH, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(offsets, keys + [_CH])
            .select(*df.columns, (F.col("_lrn") + F.col("_off")).cast("int").alias(out)))


def asof_next(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str,
              payload: Sequence[str], prefix: str = "next_", strict: bool = False,
              chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Forward as-of join: for each left row, the first right row of the same key
    with ``right_t >= left_t`` (``>`` when ``strict``).

    Adds ``prefix + c`` for ``right_t`` and every payload column (null when no
    such row exists). Left rows are kept one for one. Built as one union and
    one ``forward_fill`` (a single sort per key and time chunk).
    """
    keys = list(keys)
    left_cols = [c for c in left.columns if c not in keys]
    pay_cols = [right_t] + [c for c in payload if c != right_t]
    pay_type = right.select(F.struct(*pay_cols).alias("p")).schema["p"].dataType
    left_type = left.select(F.struct(*left_cols).alias("l")).schema["l"].dataType
    # at equal times a left row sees right rows ordered after it: ties 0 / 1
    # for ">=", and 1 / 0 for ">"
    lt, rt = (1, 0) if strict else (0, 1)
    lpart = left.select(*keys, F.col(left_t).alias("_t"), F.lit(lt).alias("_tie"), F.lit(True).alias("_is_left"),
                        F.struct(*left_cols).alias("_left"), F.lit(None).cast(pay_type).alias("_pay"))
    rpart = right.select(*keys, F.col(right_t).alias("_t"), F.lit(rt).alias("_tie"), F.lit(False).alias("_is_left"),
                         F.lit(None).cast(left_type).alias("_left"), F.struct(*pay_cols).alias("_pay"))
    filled = forward_fill(lpart.unionByName(rpart), keys, "_t", "_tie", ["_pay"], prefix="_m",
                          chunk_seconds=chunk_seconds)
    m = F.col("_m_pay")
    return (filled.where(F.col("_is_left"))
            .select(*keys, *[F.col("_left")[c].alias(c) for c in left_cols],
                    *[m[c].alias(prefix + c) for c in pay_cols]))


def forward_fill(df: DataFrame, keys: Sequence[str], t: str, tie: str, cols: Sequence[str],
                 prefix: str = "next_", chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """For every row and every column ``c`` of ``cols``: the first non-null ``c``
    at this row or after it, in ascending ``(t, tie)`` order within ``keys``.

    Several look-ups share one sort: lookup rows carry nulls and sample rows
    carry values; ``tie`` decides what "after" means at equal times (rows with a
    smaller tie see rows with a larger one at the same time, not the reverse).
    Runs per ``(keys, chunk)``; the first value of each later chunk is carried
    in through a per-chunk summary.
    """
    keys = list(keys)
    cols = list(cols)
    d = df.withColumn(_CH, _chunk(F.col(t), chunk_seconds))
    w = (Window.partitionBy(*keys, _CH).orderBy(F.col(t).desc(), F.col(tie).desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = d.select("*", *[F.last(c, ignorenulls=True).over(w).alias("_in_" + c) for c in cols])
    # first non-null value of each column per chunk (min over (t, tie, value)),
    # a partial aggregate: one row per chunk and task is shuffled
    firsts = d.groupBy(*keys, _CH).agg(*[
        F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(t).alias("t"), F.col(tie).alias("k"),
                                                     F.col(c).alias("v")))).alias("_f_" + c)
        for c in cols])
    later = (Window.partitionBy(*keys).orderBy(F.col(_CH).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    carry = firsts.select(*keys, _CH, *[F.last(F.col("_f_" + c)["v"], ignorenulls=True).over(later)
                                        .alias("_cy_" + c) for c in cols])
    out = filled.join(carry, keys + [_CH], "left")
    return out.select(*df.columns, *[F.coalesce(F.col("_in_" + c), F.col("_cy_" + c)).alias(prefix + c)
                                     for c in cols])


def previous_row(df: DataFrame, keys: Sequence[str], t: str, tie: Sequence[str], cols: Sequence[str],
                 prefix: str = "prev_", chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """For every row, the columns ``cols`` of the row just before it in
    ascending ``(t, tie...)`` order within ``keys`` (null for the first row).

    A ``lag`` per ``(keys, chunk)``; the first row of a chunk takes the last row
    of the nearest earlier chunk that has rows, carried through a per-chunk
    summary, so a key with a third of all rows is still spread over tasks."""
    keys, cols, tie = list(keys), list(cols), list(tie)
    d = df.withColumn(_CH, _chunk(F.col(t), chunk_seconds))
    order = [F.col(t)] + [F.col(c) for c in tie]
    w = Window.partitionBy(*keys, _CH).orderBy(*order)
    row = F.struct(*[F.col(c).alias(c) for c in cols])
    local = d.select("*", F.lag(row).over(w).alias("_lag"),
                     (F.row_number().over(w) == 1).alias("_first"))
    # last row of each chunk: the max over (t, tie..., row) per chunk
    lasts = d.groupBy(*keys, _CH).agg(
        F.max(F.struct(F.col(t).alias("_t"), *[F.col(c).alias("_k" + str(i)) for i, c in enumerate(tie)],
                       row.alias("_row")))["_row"].alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(_CH).rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(*keys, _CH, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    out = local.join(carry, keys + [_CH], "left")
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))
    return out.select(*df.columns, *[prev[c].alias(prefix + c) for c in cols])


def running_sum(df: DataFrame, keys: Sequence[str], t: str, value: Column | str, out: str,
                chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Inclusive running sum of ``value`` in ascending ``t`` within ``keys``
    (``t`` unique per key; ``keys`` may be empty for one global order).

    A running frame per ``(keys, chunk)`` plus the total of all earlier chunks
    of the key, carried through the per-chunk totals, so no task holds more
    than one chunk even when there is no key at all."""
    keys = list(keys)
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("_rv", v).withColumn(_CH, _chunk(F.col(t), chunk_seconds))
    w = Window.partitionBy(*keys, _CH).orderBy(t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.withColumn("_loc", F.sum("_rv").over(w))
    totals = d.groupBy(*keys, _CH).agg(F.sum("_rv").alias("_tot"))
    before = Window.partitionBy(*keys).orderBy(_CH).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, _CH, F.coalesce(F.sum("_tot").over(before), F.lit(0.0)).alias("_off"))
    return (local.join(offsets, keys + [_CH])
            .select(*df.columns, (F.col("_loc") + F.col("_off")).alias(out)))
