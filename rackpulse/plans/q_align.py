"""Queries over the aligned-metric operators (collector part of the reference)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..operators import align
from ..session import stage_once
from .registry import SAMPLES_CTE, query

# Events are minutes apart, so queries use a 600 s half-window (API default 30 s).
HALF_WINDOW = 600


def r6(c):
    return F.round(c, 6)


ALIGNED_SQL = f"""
WITH {SAMPLES_CTE},
fw AS (SELECT day, epoch, value, row_number() OVER (PARTITION BY day ORDER BY epoch) AS rn
       FROM samples WHERE metric = 'filewrites'),
fr AS (SELECT day, epoch, value, row_number() OVER (PARTITION BY day ORDER BY epoch) AS rn
       FROM samples WHERE metric = 'filereads'),
site AS (SELECT fw.day, fw.rn, fw.epoch AS time, fw.value AS filewrites, fr.value AS filereads
         FROM fw JOIN fr ON fw.day = fr.day AND fw.rn = fr.rn),
srvcnt AS (SELECT server, day,
                  count(*) FILTER (WHERE metric = 'CPU') AS c1,
                  count(*) FILTER (WHERE metric = 'diskIOBW') AS c2,
                  count(*) FILTER (WHERE metric = 'net_bytes') AS c3
           FROM samples WHERE server IS NOT NULL GROUP BY server, day),
sitecnt AS (SELECT day, count(*) FILTER (WHERE metric = 'filewrites') AS c4,
                   count(*) FILTER (WHERE metric = 'filereads') AS c5
            FROM samples WHERE server IS NULL GROUP BY day),
lim AS (SELECT s.server, s.day, least(c1, c2, c3, c4, c5) AS keylimit
        FROM srvcnt s JOIN sitecnt t ON s.day = t.day),
grid AS (SELECT l.server, s.day, s.rn, s.time, s.filewrites, s.filereads
         FROM site s JOIN lim l ON s.day = l.day AND s.rn <= l.keylimit),
cpu AS (SELECT server, day, epoch, value FROM samples WHERE metric = 'CPU'),
disk AS (SELECT server, day, epoch, value FROM samples WHERE metric = 'diskIOBW'),
net AS (SELECT server, day, epoch, value FROM samples WHERE metric = 'net_bytes'),
cuts AS (SELECT server, day, rn, time + {HALF_WINDOW} AS cut,
                lag(time + {HALF_WINDOW}) OVER (PARTITION BY server, day ORDER BY rn) AS prev_cut
         FROM grid),
dmean AS (SELECT c.server, c.day, c.rn, avg(d.value) AS m FROM cuts c JOIN disk d
          ON d.server = c.server AND d.day = c.day AND d.epoch < c.cut
             AND (c.prev_cut IS NULL OR d.epoch >= c.prev_cut)
          GROUP BY c.server, c.day, c.rn),
nmean AS (SELECT c.server, c.day, c.rn, avg(d.value) AS m FROM cuts c JOIN net d
          ON d.server = c.server AND d.day = c.day AND d.epoch < c.cut
             AND (c.prev_cut IS NULL OR d.epoch >= c.prev_cut)
          GROUP BY c.server, c.day, c.rn),
dnext AS (SELECT c.server, c.day, c.rn, d.value, d.epoch FROM cuts c ASOF LEFT JOIN disk d
          ON c.server = d.server AND c.day = d.day AND c.cut <= d.epoch),
nnext AS (SELECT c.server, c.day, c.rn, d.value, d.epoch FROM cuts c ASOF LEFT JOIN net d
          ON c.server = d.server AND c.day = d.day AND c.cut <= d.epoch),
gcpu AS (SELECT g.*, p.value AS cpu_v, p.epoch AS cpu_t FROM grid g ASOF LEFT JOIN cpu p
         ON g.server = p.server AND g.day = p.day AND g.time <= p.epoch)
SELECT g.server, g.day, CAST(g.rn AS INTEGER) AS rn, g.time,
       round(g.filewrites, 6) AS filewrites, round(g.filereads, 6) AS filereads,
       round(g.cpu_v, 6) AS CPU,
       round(coalesce(dm.m, dn.value), 6) AS diskIOBW,
       round(coalesce(nm.m, nn.value), 6) AS net_bytes,
       (g.cpu_t IS NOT NULL AND dn.epoch IS NOT NULL AND nn.epoch IS NOT NULL) AS complete
FROM gcpu g
LEFT JOIN dmean dm ON g.server = dm.server AND g.day = dm.day AND g.rn = dm.rn
LEFT JOIN nmean nm ON g.server = nm.server AND g.day = nm.day AND g.rn = nm.rn
JOIN dnext dn ON g.server = dn.server AND g.day = dn.day AND g.rn = dn.rn
JOIN nnext nn ON g.server = nn.server AND g.day = nn.day AND g.rn = nn.rn
"""


@query("aligned_metrics", ALIGNED_SQL)
def q_aligned_metrics(spark, sf_dir):
    samples = _samples(spark, sf_dir)
    out = align.aligned_metrics(samples, HALF_WINDOW)
    return out.select("server", "day", "rn", "time",
                      *[r6(F.col(c)).alias(c) for c in T.METRICS], "complete")


def _samples(spark, sf_dir, staged: bool = True):
    """The canonical metric samples, written once per input for all plans that
    read them in several branches. Plans that read them once take them unwritten (``staged=False``), so their
    filters and column pruning reach the ``events`` scan."""
    if not staged:
        return T.metric_samples(spark, sf_dir)
    return stage_once(spark, "metric_samples", sf_dir, lambda: T.metric_samples(spark, sf_dir))


@query("series_rank", f"""
WITH {SAMPLES_CTE}
SELECT server, metric, day, epoch, round(value, 6) AS value,
       CAST(row_number() OVER (PARTITION BY server, metric, day ORDER BY epoch) AS INTEGER) AS rn
FROM samples
""")
def q_series_rank(spark, sf_dir):
    r = align.series_rank(_samples(spark, sf_dir))
    return r.select("server", "metric", "day", "epoch", r6(F.col("value")).alias("value"), "rn")


@query("positional_join", f"""
WITH {SAMPLES_CTE},
fw AS (SELECT day, epoch, value, row_number() OVER (PARTITION BY day ORDER BY epoch) AS rn
       FROM samples WHERE metric = 'filewrites'),
fr AS (SELECT day, epoch, value, row_number() OVER (PARTITION BY day ORDER BY epoch) AS rn
       FROM samples WHERE metric = 'filereads')
SELECT fw.day, CAST(fw.rn AS INTEGER) AS rn, fw.epoch AS time, fr.epoch AS read_time,
       round(fw.value, 6) AS filewrites, round(fr.value, 6) AS filereads
FROM fw JOIN fr ON fw.day = fr.day AND fw.rn = fr.rn
""")
def q_positional_join(spark, sf_dir):
    s = _samples(spark, sf_dir).where(F.col("server").isNull())
    j = align.positional_join(s.where(F.col("metric") == "filewrites"),
                              s.where(F.col("metric") == "filereads"))
    return j.select("day", "rn", "time", "read_time", r6(F.col("filewrites")).alias("filewrites"),
                    r6(F.col("filereads")).alias("filereads"))


@query("shortest_truncate", f"""
WITH {SAMPLES_CTE},
srv AS (SELECT server, day,
               count(*) FILTER (WHERE metric = 'CPU') AS n_CPU,
               count(*) FILTER (WHERE metric = 'diskIOBW') AS n_diskIOBW,
               count(*) FILTER (WHERE metric = 'net_bytes') AS n_net_bytes
        FROM samples WHERE server IS NOT NULL GROUP BY server, day),
site AS (SELECT day, count(*) FILTER (WHERE metric = 'filewrites') AS n_filewrites,
                count(*) FILTER (WHERE metric = 'filereads') AS n_filereads
         FROM samples WHERE server IS NULL GROUP BY day)
SELECT srv.server, srv.day, n_CPU, n_diskIOBW, n_net_bytes, n_filewrites, n_filereads,
       CAST(least(n_CPU, n_diskIOBW, n_net_bytes, n_filewrites, n_filereads) AS INTEGER) AS keylimit
FROM srv JOIN site ON srv.day = site.day
""")
def q_shortest_truncate(spark, sf_dir):
    return align.shortest_truncate(_samples(spark, sf_dir))


@query("asof_forward", f"""
WITH {SAMPLES_CTE},
disk AS (SELECT server, day, epoch FROM samples WHERE metric = 'diskIOBW'),
cpu AS (SELECT server, day, epoch, value FROM samples WHERE metric = 'CPU')
SELECT d.server, d.day, d.epoch AS time, round(c.value, 6) AS CPU, c.epoch AS CPU_time
FROM disk d ASOF LEFT JOIN cpu c ON d.server = c.server AND d.day = c.day AND d.epoch <= c.epoch
""")
def q_asof_forward(spark, sf_dir):
    s = _samples(spark, sf_dir)
    grid = s.where(F.col("metric") == "diskIOBW").select("server", "day", F.col("epoch").alias("time"))
    r = align.asof_forward(grid, s.where(F.col("metric") == "CPU"), ["server", "day"], out="CPU")
    return r.select("server", "day", "time", r6(F.col("CPU")).alias("CPU"), "CPU_time")


@query("bucket_mean", f"""
WITH {SAMPLES_CTE},
grid AS (SELECT server, day, epoch AS time,
                row_number() OVER (PARTITION BY server, day ORDER BY epoch) AS rn
         FROM samples WHERE metric = 'CPU'),
net AS (SELECT server, day, epoch, value FROM samples WHERE metric = 'net_bytes'),
cuts AS (SELECT server, day, rn, time, time + {HALF_WINDOW} AS cut,
                lag(time + {HALF_WINDOW}) OVER (PARTITION BY server, day ORDER BY rn) AS prev_cut
         FROM grid),
m AS (SELECT c.server, c.day, c.rn, avg(n.value) AS m, count(*) AS k FROM cuts c JOIN net n
      ON n.server = c.server AND n.day = c.day AND n.epoch < c.cut
         AND (c.prev_cut IS NULL OR n.epoch >= c.prev_cut)
      GROUP BY c.server, c.day, c.rn),
x AS (SELECT c.*, n.value AS nv, n.epoch AS ne FROM cuts c ASOF LEFT JOIN net n
      ON c.server = n.server AND c.day = n.day AND c.cut <= n.epoch)
SELECT x.server, x.day, CAST(x.rn AS INTEGER) AS rn, x.time,
       round(coalesce(m.m, x.nv), 6) AS value, coalesce(m.k, 0) AS value_n,
       x.ne IS NOT NULL AS value_ok
FROM x LEFT JOIN m ON x.server = m.server AND x.day = m.day AND x.rn = m.rn
""")
def q_bucket_mean(spark, sf_dir):
    s = _samples(spark, sf_dir)
    grid = ordered_grid(s.where(F.col("metric") == "CPU"))
    r = align.bucket_mean(grid, s.where(F.col("metric") == "net_bytes"), ["server", "day"], HALF_WINDOW)
    return r.select("server", "day", "rn", "time", r6(F.col("value")).alias("value"),
                    "value_n", "value_ok")


def ordered_grid(series):
    from ..operators.series import ordered_index
    g = series.select("server", "day", F.col("epoch").alias("time"))
    return ordered_index(g, ["server", "day"], "time", "rn")


@query("common_start", f"""
WITH {SAMPLES_CTE}
SELECT day, greatest(min(epoch) FILTER (WHERE metric = 'filewrites'),
                     min(epoch) FILTER (WHERE metric = 'filereads')) AS start_epoch
FROM samples WHERE server IS NULL GROUP BY day
HAVING count(*) FILTER (WHERE metric = 'filewrites') > 0
   AND count(*) FILTER (WHERE metric = 'filereads') > 0
""")
def q_common_start(spark, sf_dir):
    return align.common_start(_samples(spark, sf_dir, staged=False))


@query("metrics_from_json", f"""
WITH {SAMPLES_CTE}
SELECT server, metric, day, epoch, round(value, 6) AS value FROM samples
""")
def q_metrics_from_json(spark, sf_dir):
    from ..sources.metrics import build_metric_responses, parse_metric_response
    resp = build_metric_responses(_samples(spark, sf_dir, staged=False))
    p = parse_metric_response(resp, "value", series="first")
    return p.select("server", "metric", "day", "epoch", r6(F.col("value")).alias("value"))


@query("metric_select_sum", """
SELECT CAST(user_id % 7 AS INTEGER) AS server, CAST(ts AS DATE) AS day,
       CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch, round(sum(value), 6) AS value
FROM events WHERE event_type = 'purchase' GROUP BY ALL
""")
def q_metric_select_sum(spark, sf_dir):
    from ..sources.metrics import select_metric_sum
    r = select_metric_sum(T.raw_metric_events(spark, sf_dir), "diskIOBW")
    return r.select("server", "day", "epoch", r6(F.col("value")).alias("value"))


# Fixed parameters of the date-range queries (the data covers January 2024).
ANCHOR = "2024-01-31"


@query("relative_range", f"""
WITH {SAMPLES_CTE}
SELECT server, metric, day, epoch, round(value, 6) AS value FROM samples
WHERE day >= DATE '{ANCHOR}' - INTERVAL 12 DAY AND day < DATE '{ANCHOR}' - INTERVAL 2 DAY
""")
def q_relative_range(spark, sf_dir):
    from ..operators.selection import relative_range
    r = relative_range(_samples(spark, sf_dir, staged=False), "day", F.lit(ANCHOR).cast("date"), 12, 2)
    return r.select("server", "metric", "day", "epoch", r6(F.col("value")).alias("value"))


@query("day_backfill", f"""
WITH {SAMPLES_CTE},
spine AS (SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '{ANCHOR}' - INTERVAL 40 DAY,
                                                             DATE '{ANCHOR}' - INTERVAL 2 DAY,
                                                             INTERVAL 1 DAY) t(d)),
per AS (SELECT day, count(*) AS n, sum(value) AS total FROM samples GROUP BY day)
SELECT s.day, coalesce(p.n, 0) AS n_samples, round(coalesce(p.total, 0), 6) AS total
FROM spine s LEFT JOIN per p ON s.day = p.day
""")
def q_day_backfill(spark, sf_dir):
    from ..operators.selection import day_spine
    s = _samples(spark, sf_dir, staged=False)
    per = s.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    spine = day_spine(spark.range(1).select(F.lit(ANCHOR).cast("date").alias("anchor")), 40, 2)
    return (spine.join(per, "day", "left")
            .select("day", F.coalesce("n", F.lit(0)).alias("n_samples"),
                    r6(F.coalesce("total", F.lit(0.0))).alias("total")))


@query("server_fanout", f"""
WITH {SAMPLES_CTE},
sd AS (SELECT DISTINCT server, day FROM samples WHERE server IS NOT NULL)
SELECT sd.server, s.metric, s.day, s.epoch, round(s.value, 6) AS value
FROM samples s JOIN sd ON s.day = sd.day WHERE s.server IS NULL
""")
def q_server_fanout(spark, sf_dir):
    return align.server_fanout(_samples(spark, sf_dir)).select(
        "server", "metric", "day", "epoch", r6(F.col("value")).alias("value"))


@query("empty_groups", f"""
WITH {SAMPLES_CTE},
srv AS (SELECT server, day,
               count(*) FILTER (WHERE metric = 'CPU') AS n_CPU,
               count(*) FILTER (WHERE metric = 'diskIOBW') AS n_diskIOBW,
               count(*) FILTER (WHERE metric = 'net_bytes') AS n_net_bytes
        FROM samples WHERE server IS NOT NULL GROUP BY server, day),
site AS (SELECT day, count(*) FILTER (WHERE metric = 'filewrites') AS n_filewrites,
                count(*) FILTER (WHERE metric = 'filereads') AS n_filereads
         FROM samples WHERE server IS NULL GROUP BY day)
SELECT srv.server, srv.day, n_CPU, n_diskIOBW, n_net_bytes,
       coalesce(n_filewrites, 0) AS n_filewrites, coalesce(n_filereads, 0) AS n_filereads
FROM srv LEFT JOIN site ON srv.day = site.day
WHERE least(n_CPU, n_diskIOBW, n_net_bytes, coalesce(n_filewrites, 0), coalesce(n_filereads, 0)) = 0
""")
def q_empty_groups(spark, sf_dir):
    return align.empty_groups(_samples(spark, sf_dir))
