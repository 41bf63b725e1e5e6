"""Queries that write with the sinks and read back with the sources (S6-S8, S13,
K1, K3, K4, K7), through the application's folder in shared storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..session import scratch_path
from ..sources import metrics as M
from ..sources import sinks as K
from ..streaming.copies import copy_files
from .q_align import ALIGNED_SQL, q_aligned_metrics
from .q_cluster import FEATS, FLIST, ITERATIONS, POINTS_CTE, ROUNDED, _fitted, _points, lloyd_sql, r6cols
from .q_shelf import LINES_CTE
from .registry import query


@query("aligned_write", f"""
SELECT server, day, time, {FLIST} FROM ({ALIGNED_SQL}) a
""")
def q_aligned_write(spark, sf_dir):
    """K1: aligned rows in folders by server and day; the second write replaces
    only the folders it writes (the days of one server) and changes nothing."""
    path = scratch_path(spark, "aligned")
    rows = q_aligned_metrics(spark, sf_dir)
    K.write_aligned(rows, path)
    K.write_aligned(rows.where("server = 3"), path)
    return spark.read.parquet(path).select("server", "day", "time", *FEATS)


@query("aligned_csv", f"""
SELECT server, day, time, {FLIST} FROM ({ALIGNED_SQL}) a
""")
def q_aligned_csv(spark, sf_dir):
    """The headerless CSV form, read with its fixed schema."""
    path = scratch_path(spark, "aligned-csv")
    K.write_aligned(q_aligned_metrics(spark, sf_dir), path, fmt="csv")
    back = M.read_aligned_csv(spark, path).where("_corrupt is null")
    return back.select(F.col("server").cast("int").alias("server"), F.col("day").cast("date").alias("day"), "time", *FEATS)


@query("points_csv", f"""
WITH {POINTS_CTE}
SELECT {FLIST}, count(*) AS n FROM pts GROUP BY ALL
""")
def q_points_csv(spark, sf_dir):
    """K3: points under their header, read back as text and coerced."""
    path = scratch_path(spark, "points-csv")
    K.write_points_csv(_points(spark, sf_dir), path)
    return M.read_points_csv(spark, path).groupBy(*FEATS).agg(F.count("*").alias("n"))


@query("centers_csv", f"""
WITH {POINTS_CTE}, {lloyd_sql(ITERATIONS)}
SELECT {ROUNDED} FROM c{ITERATIONS}
""")
def q_centers_csv(spark, sf_dir):
    """K4: the fitted centres under the same header."""
    path = scratch_path(spark, "centers-csv")
    K.write_centers_csv(_fitted(spark, sf_dir), path)
    return r6cols(M.read_points_csv(spark, path), FEATS)


@query("delimited_text", """
SELECT o_orderkey AS k, 'say "' || o_orderstatus || '", ' || o_orderpriority || chr(10) || 'end' AS t FROM orders
""")
def q_delimited_text(spark, sf_dir):
    """K7: fields holding quotes, delimiters and line breaks come back whole."""
    path = scratch_path(spark, "delimited")
    text = F.concat(F.lit('say "'), "o_orderstatus", F.lit('", '), "o_orderpriority", F.lit("\n"), F.lit("end"))
    K.write_delimited(T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), text.alias("t")), path)
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("k long, t string").csv(path)


@query("text_logs", f"""
WITH {LINES_CTE}
SELECT value, count(*) AS n FROM lines GROUP BY value
""")
def q_text_logs(spark, sf_dir):
    """Log lines in folders by server, read by walking the folders
    and by the pattern of the file names."""
    path = scratch_path(spark, "logs")
    T.log_lines(spark, sf_dir).select("value", F.element_at(F.split("path", "/"), 2).alias("dir")).write.partitionBy("dir").text(path)
    return M.read_text_logs(spark, path, recursive=True, glob="part-*").groupBy("value").agg(F.count("*").alias("n"))


@query("file_copies", f"""
WITH {LINES_CTE}
SELECT value, count(*) AS n, 0 AS copied_again FROM lines GROUP BY value
""")
def q_file_copies(spark, sf_dir):
    """Log files in folders by server, copied as files; a second run copies none."""
    raw, target, ledger = (scratch_path(spark, x) for x in ("raw-logs", "copied-logs", "copy-ledger"))
    T.log_lines(spark, sf_dir).select("value", F.element_at(F.split("path", "/"), 2).alias("dir")).write.partitionBy("dir").text(raw)
    copy_files(spark, raw, target, ledger)
    again = copy_files(spark, raw, target, ledger).agg(F.count("*").cast("int").alias("n")).select("n").scalar()
    return (M.read_text_logs(spark, target, recursive=True, glob="part-*").groupBy("value")
            .agg(F.count("*").alias("n"), F.max(again).alias("copied_again")))
