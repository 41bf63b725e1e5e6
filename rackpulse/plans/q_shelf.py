"""Queries over the shelf-temperature log operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..operators import shelf
from .registry import query

# DuckDB form of ``tables.log_lines`` plus the directory of each file.
LINES_CTE = r"""
lines AS (
  SELECT event_id AS line_id,
         printf('logs/sense%d/%s.log', CAST(user_id % 7 AS INTEGER), strftime(ts, '%Y-%m-%d')) AS path,
         printf('logs/sense%d', CAST(user_id % 7 AS INTEGER)) AS dir,
         printf('%s sense%d %s %s %s', strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id % 13 AS INTEGER),
                CASE WHEN event_type = 'view' THEN 'Status' ELSE 'Shelf' END,
                CASE WHEN event_type = 'click' THEN 'enclosure'
                     ELSE printf('sdisk%s%d-%s', substring('ABCD', CAST(event_id % 4 + 1 AS INTEGER), 1),
                                 CAST(event_id % 3 + 1 AS INTEGER),
                                 CASE WHEN event_id % 2 = 0 THEN 'front' ELSE 'rear' END) END,
                CASE WHEN event_type = 'signup' THEN 'temp n/a'
                     ELSE printf('temp %d C', CAST(trunc(value) AS INTEGER) % 120) END) AS value
  FROM events),
parsed AS (
  SELECT line_id, path, dir, regexp_extract(value, 'sdisk\w\d-(?:rear|front)', 0) AS shelf,
         regexp_extract(value, '(\d\d) C', 1) AS t, regexp_extract(value, 'sense\d', 0) AS server
  FROM lines WHERE contains(value, 'Shelf')),
good AS (SELECT line_id, path, dir, shelf, CAST(t AS INTEGER) AS temp_c, server
         FROM parsed WHERE shelf <> '' AND t <> '')
"""


def _lines(spark, sf_dir):
    l = T.log_lines(spark, sf_dir)
    return l.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))


def _parsed(spark, sf_dir):
    return shelf.extract_shelf(_lines(spark, sf_dir))


@query("log_filter", f"""
WITH {LINES_CTE}
SELECT line_id, path, value FROM lines WHERE contains(value, 'Shelf')
""")
def q_log_filter(spark, sf_dir):
    return shelf.shelf_lines(T.log_lines(spark, sf_dir)).select("line_id", "path", "value")


@query("shelf_extract", f"""
WITH {LINES_CTE}
SELECT line_id, shelf, temp_c, server FROM good
""")
def q_shelf_extract(spark, sf_dir):
    return _parsed(spark, sf_dir).select("line_id", "shelf", "temp_c", "server")


@query("server_name", f"""
WITH {LINES_CTE},
f AS (SELECT dir, value, row_number() OVER (PARTITION BY dir ORDER BY path, line_id) AS k
      FROM lines WHERE contains(value, 'Shelf'))
SELECT dir, regexp_extract(value, 'sense\\d', 0) AS server_name FROM f WHERE k = 1
""")
def q_server_name(spark, sf_dir):
    return shelf.server_name(_lines(spark, sf_dir))


@query("server_mean", f"""
WITH {LINES_CTE}
SELECT dir, round(avg(temp_c), 6) AS mean_temp, count(*) AS n_logs FROM good GROUP BY dir
""")
def q_server_mean(spark, sf_dir):
    m = shelf.server_mean(_parsed(spark, sf_dir))
    return m.select("dir", F.round("mean_temp", 6).alias("mean_temp"), "n_logs")


@query("shelf_sum_count", f"""
WITH {LINES_CTE}
SELECT dir, shelf, CAST(sum(temp_c) AS BIGINT) AS sum_temp, count(*) AS n_logs
FROM good GROUP BY dir, shelf
""")
def q_shelf_sum_count(spark, sf_dir):
    return shelf.shelf_sum_count(_parsed(spark, sf_dir))


@query("shelf_report", f"""
WITH {LINES_CTE}
SELECT dir, shelf, CAST(GROUPING(dir, shelf) AS INTEGER) AS level, count(*) AS n_logs,
       round(sum(temp_c) / count(*), 6) AS mean_temp
FROM good GROUP BY GROUPING SETS ((dir, shelf), (dir))
""")
def q_shelf_report(spark, sf_dir):
    r = shelf.shelf_report(_parsed(spark, sf_dir))
    return r.select("dir", "shelf", "level", "n_logs", F.round("mean_temp", 6).alias("mean_temp"))
