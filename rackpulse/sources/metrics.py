"""Metric responses, metric CSVs, text logs, header CSVs.

A metric response is the JSON array the time-series store returns:
``[{"metric": ..., "tags": {...}, "dps": {"<epoch>": value, ...}}, ...]``.
Only the first element is used by the original collector (``series='first'``);
``series='sum'`` adds all elements per epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE_SCHEMA = "array<struct<metric:string,tags:map<string,string>,dps:map<string,double>>>"

ALIGNED_SCHEMA = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("filewrites", T.DoubleType()),
    T.StructField("filereads", T.DoubleType()),
    T.StructField("CPU", T.DoubleType()),
    T.StructField("diskIOBW", T.DoubleType()),
    T.StructField("net_bytes", T.DoubleType()),
    T.StructField("_corrupt", T.StringType()),
])

POINTS_COLUMNS = ["filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"]


def day_of_epoch(epoch: Column) -> Column:
    """Calendar day (UTC) of epoch seconds, without the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch / 86400).cast("int"))


#: How host names carry the server's number, and the name that stands for all.
HOST_PATTERN, HOST_NAME, SITE_HOST = r"^node(\d+)", "node%d.example", "site"


def server_of_host(host: Column, pattern: str = HOST_PATTERN) -> Column:
    """``node3.example`` -> 3; hosts of another form (site-wide) give null."""
    n = F.regexp_extract(host, pattern, 1)
    return F.when(n != "", n.cast("int"))


def parse_metric_response(df: DataFrame, text_col: str = "value", series: str = "first",
                          keep: Sequence[str] = (), host_pattern: str = HOST_PATTERN) -> DataFrame:
    """Decode response text into ``(keep..., metric, server, day, epoch, value)``."""
    arr = F.from_json(F.col(text_col), RESPONSE_SCHEMA)
    if series == "first":
        one = df.select(*keep, F.element_at(arr, 1).alias("_r"))
        kv = one.select(*keep, F.col("_r.metric").alias("metric"),
                        F.col("_r.tags")["host"].alias("host"),
                        F.explode(F.col("_r.dps")).alias("_k", "value"))
    elif series == "sum":
        allr = df.select(*keep, F.explode(arr).alias("_r"))
        kv = (allr.select(*keep, F.col("_r.metric").alias("metric"),
                          F.col("_r.tags")["host"].alias("host"),
                          F.explode(F.col("_r.dps")).alias("_k", "value"))
              .groupBy(*keep, "metric", "host", "_k").agg(F.sum("value").alias("value")))
    else:
        raise ValueError("series must be 'first' or 'sum'")
    epoch = F.col("_k").cast("long")
    return kv.select(*keep, "metric", server_of_host(F.col("host"), host_pattern).alias("server"),
                     day_of_epoch(epoch).alias("day"), epoch.alias("epoch"), "value")


def read_metric_responses(spark: SparkSession, paths: str | Sequence[str],
                          series: str = "first") -> DataFrame:
    """S1 on files: one response per file (read whole), many files in one scan."""
    df = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return parse_metric_response(df, "value", series, keep=["path"])


def build_metric_responses(samples: DataFrame, op_series: bool = True) -> DataFrame:
    """Encode ``metric_samples`` as responses, one per (server, metric, day, hour).

    The first element holds the summed series; with ``op_series`` a second
    element holds a per-operation series (twice the value) that parsing with
    ``series='first'`` must ignore. Responses are cut per hour so that no
    single response holds an unbounded group.
    """
    host = F.when(F.col("server").isNull(), F.lit(SITE_HOST)) \
        .otherwise(F.format_string(HOST_NAME, F.col("server")))
    g = (samples.withColumn("_hour", F.floor(F.col("epoch") / 3600))
         .groupBy("server", "metric", "day", "_hour")
         .agg(F.map_from_entries(F.collect_list(
             F.struct(F.col("epoch").cast("string"), F.col("value")))).alias("dps"),
             F.map_from_entries(F.collect_list(
                 F.struct(F.col("epoch").cast("string"), F.col("value") * 2))).alias("dps2")))
    first = F.struct(F.col("metric"), F.create_map(F.lit("host"), host).alias("tags"), F.col("dps"))
    second = F.struct(F.col("metric"),
                      F.create_map(F.lit("host"), host, F.lit("op"), F.lit("write")).alias("tags"),
                      F.col("dps2").alias("dps"))
    arr = F.array(first, second) if op_series else F.array(first)
    return g.select("server", "metric", "day", F.to_json(arr).alias("value"))


def select_metric_sum(raw: DataFrame, metric: str, servers: Sequence[int] | None = None) -> DataFrame:
    """One metric by name (and host tag), summed per (server, day, epoch)."""
    d = raw.where(F.col("metric") == metric)
    if servers is not None:
        d = d.where(F.col("server").isin(list(servers)))
    return d.groupBy("server", "day", "epoch").agg(F.sum("value").alias("value"))


def read_aligned_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Headerless aligned-row CSVs with a fixed schema; bad rows are kept
    in ``_corrupt`` (PERMISSIVE) rather than aborting the job."""
    return (spark.read.schema(ALIGNED_SCHEMA)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
            .csv(paths))


def read_text_logs(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False,
                   glob: str | None = None) -> DataFrame:
    """Text lines with their file path; one scan over all files."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(paths).select("value", F.col("_metadata.file_path").alias("path"))


def read_points_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header CSV read as strings, then coerced to double (null when not a number)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(paths)
    return coerce_numbers(raw, [c for c in raw.columns])


def coerce_numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``+value`` of the browser: numbers from text; blanks and junk give null."""
    out = df
    for c in cols:
        out = out.withColumn(c.replace(" ", "_"), F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)"))
        if " " in c:
            out = out.drop(c)
    return out
