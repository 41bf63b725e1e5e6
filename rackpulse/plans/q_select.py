"""Queries over selection by day, freshness and request (S9-S12, S14, K5, F2,
P7, P8, J4, W3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..operators import selection as S
from .registry import SAMPLES_CTE, query

CATALOG_CTE = """
catalog AS (
  SELECT server, day, part, strftime(first_ts, '%Y-%m-%d-%H-%M') AS name,
         printf('/data/metrics/sense%d/%s', server, strftime(first_ts, '%Y-%m-%d-%H-%M')) AS path,
         printf('/data/raw/sense%d/ %s ', server, strftime(first_ts, '%Y-%m-%d %H:%M:%S')) AS raw_path,
         modified, n_rows
  FROM (SELECT user_id AS server, CAST(ts AS DATE) AS day, CAST(floor(hour(ts) / 12) AS INTEGER) AS part,
               min(ts) AS first_ts, max(ts) AS modified, count(*) AS n_rows
        FROM events GROUP BY ALL))
"""

REQUESTS_CTE = r"""
req AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 23 <> 0 THEN printf('sense%d', CAST(user_id % 7 AS INTEGER)) END AS server,
         CASE event_id % 10
           WHEN 0 THEN printf('%04d-%02d-%02d', year(ts), month(ts) + 12, day(ts))
           WHEN 1 THEN printf('%04d-02-%02d', year(ts), 29 + event_id % 3)
           WHEN 2 THEN printf('%04d-02-29', year(ts) - 1)
           WHEN 3 THEN printf('%04d-%02d-%02d', year(ts) + 5, month(ts), day(ts))
           WHEN 4 THEN printf('%d-%d-%d', year(ts), month(ts), day(ts))
           WHEN 5 THEN NULL
           ELSE strftime(ts, '%Y-%m-%d') END AS start_date,
         CASE event_id % 4
           WHEN 0 THEN NULL WHEN 1 THEN 'soon'
           WHEN 2 THEN strftime(CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER), '%Y-%m-%d')
           ELSE strftime(CAST(ts AS DATE) - 2, '%Y-%m-%d') END AS end_date
  FROM events WHERE event_type = 'purchase'),
chk AS (
  SELECT *,
    coalesce(regexp_full_match(start_date, '\d{4}-\d{2}-\d{2}')
             AND try_strptime(start_date, '%Y-%m-%d') IS NOT NULL
             AND year(try_strptime(start_date, '%Y-%m-%d')) <= year(DATE 'ASOF'), false) AS start_ok,
    coalesce(regexp_full_match(end_date, '\d{4}-\d{2}-\d{2}')
             AND try_strptime(end_date, '%Y-%m-%d') IS NOT NULL
             AND year(try_strptime(end_date, '%Y-%m-%d')) <= year(DATE 'ASOF'), false) AS end_ok
  FROM req),
modes AS (
  SELECT request_id, server, start_date, end_date,
         CASE WHEN server IS NULL THEN 'reject'
              WHEN start_date IS NULL OR NOT start_ok THEN 'reject'
              WHEN end_date IS NULL OR NOT end_ok THEN 'single'
              ELSE 'range' END AS mode,
         start_ok
  FROM chk)
"""

# Fixed parameters (the data covers January 2024).
ASOF = "2024-12-31"
DAY = "2024-01-07"
RANGE = ("2024-01-03", "2024-01-20")
MONTH_START = "20240115"
NOW = "2024-01-31 00:00:00"

REQ = REQUESTS_CTE.replace("ASOF", ASOF)


def _catalog(spark, sf_dir):
    return S.file_catalog(T.table(spark, sf_dir, "events"))


@query("day_select", f"""
WITH {CATALOG_CTE}
SELECT server, day, path FROM catalog WHERE regexp_matches(path, '/{DAY}.{{6}}')
""")
def q_day_select(spark, sf_dir):
    return S.select_day(_catalog(spark, sf_dir), DAY).select("server", "day", "path")


CONTIG_SQL = f"""
firsts AS (SELECT server, day, min(path) AS path FROM catalog
           WHERE day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' GROUP BY server, day),
ranked AS (SELECT *, row_number() OVER (PARTITION BY server ORDER BY day) AS rk FROM firsts),
contig AS (SELECT server, day, path FROM ranked WHERE date_diff('day', DATE '{RANGE[0]}', day) = rk - 1)
"""


@query("date_range_contiguous", f"""
WITH {CATALOG_CTE}, {CONTIG_SQL}
SELECT server, day, path FROM contig
""")
def q_date_range_contiguous(spark, sf_dir):
    return S.contiguous_range(_catalog(spark, sf_dir), *RANGE).select("server", "day", "path")


@query("output_name", f"""
WITH {CATALOG_CTE}, {CONTIG_SQL}
SELECT server, strftime(min(day), '%Y-%m-%d') || '_' || strftime(max(day), '%m-%d')
       || '_sense' || server AS name
FROM contig GROUP BY server
""")
def q_output_name(spark, sf_dir):
    return S.output_name(S.contiguous_range(_catalog(spark, sf_dir), *RANGE))


@query("month_tail_select", f"""
WITH {CATALOG_CTE}
SELECT server, day, path FROM catalog
WHERE (contains(path, '{MONTH_START[:6]}') OR contains(path, '{MONTH_START[:4]}-{MONTH_START[4:6]}'))
  AND CAST(substring(path, length(path) - 7, 2) AS INTEGER) >= {int(MONTH_START[6:])}
""")
def q_month_tail_select(spark, sf_dir):
    return S.month_tail(_catalog(spark, sf_dir), MONTH_START).select("server", "day", "path")


@query("fresh_rows", f"""
SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch FROM events
WHERE CAST(floor(epoch_us(ts) / 1000000) AS BIGINT)
      >= CAST(floor(epoch_us(TIMESTAMP '{NOW}') / 1000000) AS BIGINT) - 7200
""")
def q_fresh_rows(spark, sf_dir):
    ev = S.fresh(T.table(spark, sf_dir, "events"), "ts", F.lit(NOW).cast("timestamp_ntz"), 7200)
    return ev.select("event_id", T.epoch_seconds(F.col("ts")).alias("epoch"))


@query("clean_name", f"""
WITH {CATALOG_CTE}
SELECT raw_path, replace(trim(string_split(raw_path, '/')[-1]), ':', '-') AS clean_name FROM catalog
""")
def q_clean_name(spark, sf_dir):
    return _catalog(spark, sf_dir).select("raw_path", S.clean_name(F.col("raw_path")).alias("clean_name"))


@query("stamp_name", """
SELECT event_id, strftime(ts, '%Y-%m-%d-%H-%M') AS stamp_name FROM events
""")
def q_stamp_name(spark, sf_dir):
    return T.table(spark, sf_dir, "events").select("event_id", S.stamp_name(F.col("ts")).alias("stamp_name"))


@query("valid_date", f"""
WITH {REQ}
SELECT request_id, start_date, start_ok AS valid FROM chk
""")
def q_valid_date(spark, sf_dir):
    r = T.requests(spark, sf_dir)
    return r.select("request_id", "start_date",
                    S.valid_date(F.col("start_date"), F.lit(ASOF).cast("date")).alias("valid"))


@query("request_mode", f"""
WITH {REQ}
SELECT request_id, server, start_date, end_date, mode FROM modes
""")
def q_request_mode(spark, sf_dir):
    return S.request_mode(T.requests(spark, sf_dir), F.lit(ASOF).cast("date"))


@query("request_range_join", f"""
WITH {SAMPLES_CTE}, {REQ},
daily AS (SELECT server, day, count(*) AS n_samples, sum(value) AS total
          FROM samples WHERE server IS NOT NULL GROUP BY server, day),
acc AS (SELECT request_id, CAST(substring(server, 6) AS INTEGER) AS server_no,
               CAST(start_date AS DATE) AS s,
               CASE WHEN mode = 'range' THEN CAST(end_date AS DATE) ELSE CAST(start_date AS DATE) END AS e
        FROM modes WHERE mode IN ('single', 'range'))
SELECT a.request_id, a.server_no AS server, count(*) AS n_days,
       CAST(sum(d.n_samples) AS BIGINT) AS n_samples, round(sum(d.total), 6) AS total
FROM acc a JOIN daily d ON d.server = a.server_no AND d.day BETWEEN a.s AND a.e
GROUP BY a.request_id, a.server_no
""")
def q_request_range_join(spark, sf_dir):
    modes = S.request_mode(T.requests(spark, sf_dir), F.lit(ASOF).cast("date"))
    modes = modes.withColumn("server", F.regexp_extract("server", r"^sense(\d+)$", 1).cast("int"))
    j = S.request_range_join(modes, T.daily_samples(spark, sf_dir))
    return (j.groupBy("request_id", "server")
            .agg(F.count(F.lit(1)).alias("n_days"), F.sum("n_samples").alias("n_samples"),
                 F.round(F.sum("total"), 6).alias("total")))


@query("request_whole", f"""
WITH {SAMPLES_CTE}, {REQ},
daily AS (SELECT server, day, count(*) AS n_samples, sum(value) AS total
          FROM samples WHERE server IS NOT NULL GROUP BY server, day),
cli AS (SELECT request_id, CAST(substring(server, 6) AS INTEGER) AS server_no, start_date,
               CASE WHEN server IS NULL THEN 'reject' WHEN start_date IS NULL THEN 'whole' ELSE mode END AS mode, end_date FROM modes),
acc AS (SELECT request_id, server_no, mode, CAST(start_date AS DATE) AS s,
               CASE WHEN mode = 'range' THEN CAST(end_date AS DATE) ELSE CAST(start_date AS DATE) END AS e
        FROM cli WHERE mode IN ('single', 'range')
        UNION ALL SELECT request_id, server_no, mode, DATE '0001-01-01', DATE '9999-12-31' FROM cli WHERE mode = 'whole')
SELECT a.request_id, a.server_no AS server, a.mode, min(d.day) AS first_day, max(d.day) AS last_day, count(*) AS n_days,
       CAST(sum(d.n_samples) AS BIGINT) AS n_samples, round(sum(d.total), 6) AS total
FROM acc a JOIN daily d ON d.server = a.server_no AND d.day BETWEEN a.s AND a.e
GROUP BY a.request_id, a.server_no, a.mode
""")
def q_request_whole(spark, sf_dir):
    """P8, as the command line takes requests: one without any date means all days of
    its server. (A request that lacks its start is given without its end here.)"""
    given = T.requests(spark, sf_dir).withColumn("end_date", F.when(F.col("start_date").isNotNull(), F.col("end_date")))
    modes = S.request_mode(given, F.lit(ASOF).cast("date"), cli=True)
    modes = modes.withColumn("server", F.regexp_extract("server", r"^sense(\d+)$", 1).cast("int"))
    j = S.request_range_join(modes, T.daily_samples(spark, sf_dir), whole=True)
    return (j.groupBy("request_id", "server", "mode")
            .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_days"),
                 F.sum("n_samples").alias("n_samples"), F.round(F.sum("total"), 6).alias("total")))
