"""Alignment of irregular metric series onto one time grid per server and day.

The aligned row (time, filewrites, filereads, CPU, diskIOBW, net_bytes) is
built as in the collector:

* the grid is the site-wide ``filewrites`` series of the day; ``filereads`` is
  paired with it *by position* (i-th with i-th), not by time (J1);
* the grid is cut to the shortest of the five series of that server-day (J2);
* CPU is the first sample at or after the grid time (forward as-of, J3);
* diskIOBW and net_bytes are bucket means: row i averages the samples in
  ``[t(i-1) + h, t(i) + h)`` (row 1 takes everything before ``t(1) + h``); an
  empty bucket takes the next sample at or after ``t(i) + h`` (G1, G2).

Where the original aborts (a series that ends before the cut), the row is kept
with ``complete = false``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import DEFAULT_CHUNK_SECONDS, asof_next, forward_fill, ordered_index

SITE = -1  # key of site-wide series inside the ordered helpers


def series_rank(samples: DataFrame, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Rank of each sample in time order within (server, metric, day)."""
    keyed = samples.withColumn("_srv", F.coalesce(F.col("server"), F.lit(SITE)))
    ranked = ordered_index(keyed, ["_srv", "metric", "day"], "epoch", "rn", chunk_seconds)
    return ranked.drop("_srv")


def positional_join(writes: DataFrame, reads: DataFrame,
                    chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Pair the i-th write sample with the i-th read sample of each day.

    Inputs have (day, epoch, value). The output time is the write time; the
    pairing stops at the shorter series.
    """
    w = ordered_index(writes.select("day", "epoch", "value"), ["day"], "epoch", "rn", chunk_seconds)
    r = ordered_index(reads.select("day", "epoch", "value"), ["day"], "epoch", "rn", chunk_seconds)
    return (w.select("day", "rn", F.col("epoch").alias("time"), F.col("value").alias("filewrites"))
            .join(r.select("day", "rn", F.col("epoch").alias("read_time"),
                           F.col("value").alias("filereads")), ["day", "rn"]))


def series_counts(samples: DataFrame) -> DataFrame:
    """Per server-day sample counts of the five series (site-wide counts per day)."""
    site = (samples.where(F.col("server").isNull())
            .groupBy("day")
            .agg(F.count_if(F.col("metric") == "filewrites").alias("n_filewrites"),
                 F.count_if(F.col("metric") == "filereads").alias("n_filereads")))
    srv = (samples.where(F.col("server").isNotNull())
           .groupBy("server", "day")
           .agg(F.count_if(F.col("metric") == "CPU").alias("n_CPU"),
                F.count_if(F.col("metric") == "diskIOBW").alias("n_diskIOBW"),
                F.count_if(F.col("metric") == "net_bytes").alias("n_net_bytes")))
    return srv.join(site, "day")


def shortest_truncate(samples: DataFrame) -> DataFrame:
    """Rows per server-day = length of the shortest of the five series."""
    c = series_counts(samples)
    return c.select("server", "day", *[F.col(x) for x in c.columns if x.startswith("n_")],
                    F.least(*[F.col(x) for x in c.columns if x.startswith("n_")])
                    .cast("int").alias("keylimit"))


def asof_forward(grid: DataFrame, samples: DataFrame, keys: Sequence[str], t: str = "time",
                 value: str = "value", out: str = "value",
                 chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """For each grid row the first sample at or after ``t`` (same keys).

    Adds ``out`` (null when the series ends before ``t``) and ``out + '_time'``.
    """
    s = samples.select(*keys, F.col("epoch").alias("_st"), F.col(value).alias("_sv"))
    res = asof_next(grid, s, keys, t, "_st", ["_sv"], prefix="_n", chunk_seconds=chunk_seconds)
    return (res.withColumnRenamed("_n_sv", out).withColumnRenamed("_n_st", out + "_time"))


def bucket_mean(grid: DataFrame, samples: DataFrame, keys: Sequence[str], half_window: int = 30,
                t: str = "time", out: str = "value",
                chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """G1 + G2: mean of the samples between consecutive cuts ``t + half_window``.

    ``grid`` has (keys, rn, t); ``samples`` has (keys, epoch, value). Returns
    the grid rows with ``out`` (bucket mean, or the next sample when the bucket
    is empty), ``out + '_n'`` (samples in the bucket) and ``out + '_ok'``
    (false when no sample lies at or after the cut: the original aborts there).
    """
    keys = list(keys)
    cuts = grid.select(*keys, "rn", t, (F.col(t) + F.lit(half_window)).alias("_cut"))
    s = samples.select(*keys, "epoch", "value")
    # each sample belongs to the first cut strictly after it
    assigned = asof_next(s, cuts.select(*keys, "_cut", "rn"), keys, "epoch", "_cut", ["rn"],
                         prefix="_b", strict=True, chunk_seconds=chunk_seconds)
    means = (assigned.where(F.col("_brn").isNotNull())
             .groupBy(*keys, F.col("_brn").alias("rn"))
             .agg(F.avg("value").alias("_mean"), F.count(F.lit(1)).alias("_n")))
    nxt = asof_next(cuts, s, keys, "_cut", "epoch", ["value"], prefix="_x",
                    chunk_seconds=chunk_seconds)
    return (nxt.join(means, keys + ["rn"], "left")
            .select(*keys, "rn", t,
                    F.coalesce(F.col("_mean"), F.col("_xvalue")).alias(out),
                    F.coalesce(F.col("_n"), F.lit(0)).alias(out + "_n"),
                    F.col("_xepoch").isNotNull().alias(out + "_ok")))


PARTS = 16  # tasks that share a day's site-wide rows


def _spread(site_rows: DataFrame, number: Column) -> DataFrame:
    """A day's site-wide rows dealt to ``PARTS`` parts, so that no task fans out
    a whole day to all servers."""
    return site_rows.withColumn("_part", F.pmod(number, F.lit(PARTS)).cast("int"))


def _copied(server_days: DataFrame) -> DataFrame:
    """The (short) rows per server and day, once for each part."""
    return server_days.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def aligned_metrics(samples: DataFrame, half_window: int = 30,
                    chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """J6 (flagship): the five aligned metrics per server, day and grid row.

    ``samples`` is ``metric_samples(server, metric, day, epoch, value)`` with
    unique epochs per series. Output: server, day, rn, time, filewrites,
    filereads, CPU, diskIOBW, net_bytes, complete.

    Plan: the site-wide grid is built once per day (positional pairing of the
    ranked write and read series) and fanned out to the server-days that have
    data; then grid rows (at t), cut rows (at t + h) and the samples form one
    union that is sorted once per (server, day, time chunk). One forward fill
    gives every grid row its CPU sample, every cut row the next disk/net sample
    and every sample its bucket (the first cut strictly after it); one
    aggregate per grid row then assembles the wide row.

    ``samples`` should be a written table (``session.stage``): several
    branches read it, each with its own column pruning and filters.
    """
    site = F.col("server").isNull()
    metric = F.col("metric")
    # positional pairing (J1): i-th write with i-th read of the day; only the
    # two site-wide series are ranked (the filter reaches the scan)
    site_series = ordered_index(
        samples.where(site & metric.isin("filewrites", "filereads")).select("metric", "day", "epoch", "value"),
        ["metric", "day"], "epoch", "rn", chunk_seconds)
    grid_site = (site_series.groupBy("day", "rn")
                 .agg(F.max(F.when(metric == "filewrites", F.col("epoch"))).alias("time"),
                      F.max(F.when(metric == "filewrites", F.col("value"))).alias("filewrites"),
                      F.max(F.when(metric == "filereads", F.col("value"))).alias("filereads"))
                 .where(F.col("time").isNotNull() & F.col("filereads").isNotNull()))
    # truncation to the shortest series (J2); server-days lacking a series drop out
    # all five counts come from one aggregate; a day's site-wide counts (null
    # server) reach its servers over the few rows of the day
    counts = samples.groupBy("server", "day").agg(
        *[F.count_if(site & (metric == m)).alias("n_" + m) for m in ("filewrites", "filereads")],
        *[F.count_if(~site & (metric == m)).alias("n_" + m) for m in ("CPU", "diskIOBW", "net_bytes")])
    of_day = Window.partitionBy("day")
    limits = (counts.select("server", "day", F.least("n_CPU", "n_diskIOBW", "n_net_bytes", F.sum("n_filewrites").over(of_day),
                                                     F.sum("n_filereads").over(of_day)).alias("keylimit"))
              .where(F.col("server").isNotNull() & (F.col("keylimit") > 0)))
    # fan the site-wide grid out to the servers that have data that day
    grid = (_spread(grid_site, F.col("rn")).join(_copied(limits), ["day", "_part"])
            .where(F.col("rn") <= F.col("keylimit"))
            .select("server", "day", "rn", "time", "filewrites", "filereads"))

    def sample_of(m):
        return F.when(~site & (metric == m), F.struct(F.col("epoch").alias("t"), F.col("value").alias("v")))

    none_s = F.lit(None).cast("struct<t:bigint,v:double>")
    lookups = grid.select(
        "server", "day", F.explode(F.array(
            F.struct(F.lit("grid").alias("role"), F.col("time").alias("t")),
            F.struct(F.lit("cut").alias("role"), (F.col("time") + F.lit(half_window)).alias("t")))).alias("_r"),
        "rn", "time", "filewrites", "filereads")
    lookups = lookups.select(
        "server", "day", F.col("_r.role").alias("role"), F.col("_r.t").alias("t"), F.lit(0).alias("tie"),
        "rn", "time", "filewrites", "filereads", F.lit(None).cast("string").alias("metric"),
        F.lit(None).cast("double").alias("value"),
        none_s.alias("cpu"), none_s.alias("disk"), none_s.alias("net"),
        F.when(F.col("_r.role") == "cut", F.col("rn")).alias("cut_rn"))
    samp = samples.where(~site).select(
        "server", "day", F.lit("sample").alias("role"), F.col("epoch").alias("t"), F.lit(1).alias("tie"),
        F.lit(None).cast("int").alias("rn"), F.lit(None).cast("long").alias("time"),
        F.lit(None).cast("double").alias("filewrites"), F.lit(None).cast("double").alias("filereads"),
        "metric", "value", sample_of("CPU").alias("cpu"), sample_of("diskIOBW").alias("disk"),
        sample_of("net_bytes").alias("net"), F.lit(None).cast("int").alias("cut_rn"))
    filled = forward_fill(lookups.unionByName(samp), ["server", "day"], "t", "tie",
                          ["cpu", "disk", "net", "cut_rn"], chunk_seconds=chunk_seconds)
    role = F.col("role")
    k = F.when(role == "sample", F.col("next_cut_rn")).otherwise(F.col("rn"))
    is_grid, is_cut, is_sample = role == "grid", role == "cut", role == "sample"

    def from_role(cond, c):
        return F.max(F.when(cond, c))

    agg = (filled.withColumn("_k", k).where(F.col("_k").isNotNull())
           .groupBy("server", "day", "_k")
           .agg(from_role(is_grid, F.col("time")).alias("time"),
                from_role(is_grid, F.col("filewrites")).alias("filewrites"),
                from_role(is_grid, F.col("filereads")).alias("filereads"),
                from_role(is_grid, F.col("next_cpu")["v"]).alias("CPU"),
                from_role(is_grid, F.col("next_cpu")["t"]).alias("_cpu_t"),
                from_role(is_cut, F.col("next_disk")["v"]).alias("_dnext"),
                from_role(is_cut, F.col("next_disk")["t"]).alias("_dnext_t"),
                from_role(is_cut, F.col("next_net")["v"]).alias("_nnext"),
                from_role(is_cut, F.col("next_net")["t"]).alias("_nnext_t"),
                F.avg(F.when(is_sample & (metric == "diskIOBW"), F.col("value"))).alias("_dm"),
                F.avg(F.when(is_sample & (metric == "net_bytes"), F.col("value"))).alias("_nm"),
                F.max(is_grid.cast("int")).alias("_has_grid")))
    return (agg.where(F.col("_has_grid") == 1)
            .select("server", "day", F.col("_k").cast("int").alias("rn"), "time", "filewrites", "filereads",
                    "CPU", F.coalesce("_dm", "_dnext").alias("diskIOBW"),
                    F.coalesce("_nm", "_nnext").alias("net_bytes"),
                    (F.col("_cpu_t").isNotNull() & F.col("_dnext_t").isNotNull()
                     & F.col("_nnext_t").isNotNull()).alias("complete")))


def common_start(samples: DataFrame) -> DataFrame:
    """Per day, the later of the first write and the first read time."""
    site = samples.where(F.col("server").isNull())
    g = site.groupBy("day").agg(
        F.min(F.when(F.col("metric") == "filewrites", F.col("epoch"))).alias("_w"),
        F.min(F.when(F.col("metric") == "filereads", F.col("epoch"))).alias("_r"))
    return (g.where(F.col("_w").isNotNull() & F.col("_r").isNotNull())
            .select("day", F.greatest("_w", "_r").alias("start_epoch")))


def server_fanout(samples: DataFrame) -> DataFrame:
    """Copy each site-wide sample to every server with data that day.

    An equi-join on ``day`` with the distinct server-days (no cross join)."""
    sd = samples.where(F.col("server").isNotNull()).select("server", "day").distinct()
    site = samples.where(F.col("server").isNull()).drop("server")
    return _spread(site, F.col("epoch")).join(_copied(sd), ["day", "_part"]).drop("_part")


def empty_groups(samples: DataFrame) -> DataFrame:
    """K2: server-days that would write an empty file (some series has no
    sample), with the counts that say which."""
    srv = (samples.where(F.col("server").isNotNull())
           .groupBy("server", "day")
           .agg(F.count_if(F.col("metric") == "CPU").alias("n_CPU"),
                F.count_if(F.col("metric") == "diskIOBW").alias("n_diskIOBW"),
                F.count_if(F.col("metric") == "net_bytes").alias("n_net_bytes")))
    site = (samples.where(F.col("server").isNull()).groupBy("day")
            .agg(F.count_if(F.col("metric") == "filewrites").alias("n_filewrites"),
                 F.count_if(F.col("metric") == "filereads").alias("n_filereads")))
    j = srv.join(site, "day", "left").fillna(0, ["n_filewrites", "n_filereads"])
    counts = ["n_CPU", "n_diskIOBW", "n_net_bytes", "n_filewrites", "n_filereads"]
    return j.where(F.least(*[F.col(c) for c in counts]) == 0).select("server", "day", *counts)
