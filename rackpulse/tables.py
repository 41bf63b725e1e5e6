"""Driver tables and the telemetry tables Spark derives from them.

The driver ships Parquet tables only. The telemetry schema is derived from
are derived with Column expressions, so every query's work grows with the
input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timefns import epoch_micros, text

# The five metric names of the aligned row, in file order, and
# the event type each is derived from.
METRICS = ["filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"]
EVENT_METRIC = {
    "view": "filewrites",
    "click": "filereads",
    "error": "CPU",
    "purchase": "diskIOBW",
    "signup": "net_bytes",
}
SITE_METRICS = ["filewrites", "filereads"]
SERVER_METRICS = ["CPU", "diskIOBW", "net_bytes"]
N_SERVERS = 7

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp_ntz column (time-zone free)."""
    return F.floor(epoch_micros(ts) / 1000000)


def metric_expr(event_type: Column) -> Column:
    out = None
    for ev, metric in EVENT_METRIC.items():
        out = (F.when(event_type == ev, F.lit(metric)) if out is None
               else out.when(event_type == ev, F.lit(metric)))
    return out


def raw_metric_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event in telemetry form, before de-duplicating the epoch key."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    metric = metric_expr(F.col("event_type"))
    server = F.when(~F.col("event_type").isin("view", "click"),
                    (F.col("user_id") % N_SERVERS).cast("int"))
    return ev.select(
        server.alias("server"),
        metric.alias("metric"),
        F.to_date("ts").alias("day"),
        epoch_seconds(F.col("ts")).alias("epoch"),
        F.col("value"),
    ).where(F.col("metric").isNotNull())


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``metric_samples(server int, metric, day date, epoch bigint, value double)``.

    The value is summed per (server, metric, epoch), which makes the key
    unique as a JSON ``dps`` object does (operator S2's ``sum:`` aggregator).
    Site-wide series have a null server.
    """
    raw = raw_metric_events(spark, sf_dir)
    return raw.groupBy("server", "metric", "day", "epoch").agg(F.sum("value").alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shelf-monitor log lines built from ``events`` (one line per event).

    The lines exercise every branch of the shelf parser: lines without the
    word ``Shelf``, lines without a shelf id or without a temperature, one-
    and three-digit temperatures, two-digit server numbers, front and rear.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    server_no = F.col("user_id") % 13
    shelf = F.format_string("sdisk%s%d-%s",
                            F.substring(F.lit("ABCD"), (F.col("event_id") % 4 + 1).cast("int"), 1),
                            (F.col("event_id") % 3 + 1).cast("int"),
                            F.when(F.col("event_id") % 2 == 0, "front").otherwise("rear"))
    temp = (F.col("value").cast("int") % 120).cast("int")
    word = F.when(F.col("event_type") == "view", F.lit("Status")).otherwise(F.lit("Shelf"))
    shelf_part = F.when(F.col("event_type") == "click", F.lit("enclosure")).otherwise(shelf)
    temp_part = F.when(F.col("event_type") == "signup", F.lit("temp n/a")) \
        .otherwise(F.format_string("temp %d C", temp))
    line = F.format_string("%s sense%d %s %s %s", text(F.col("ts")),
                           server_no.cast("int"), word, shelf_part, temp_part)
    return ev.select(
        F.col("event_id").alias("line_id"),
        F.format_string("logs/sense%d/%s.log", (F.col("user_id") % N_SERVERS).cast("int"),
                        F.col("ts").cast("date").cast("string")).alias("path"),
        line.alias("value"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustering job requests derived from ``purchase`` events.

    Dates are the event's day, with deliberate faults by ``event_id``: month
    13, 29-31 February, a non-leap 29 February, a future year, no zero
    padding, a missing start; ends are missing, not a date, or before the start.
    """
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase") \
        .select("event_id", "user_id", "ts")
    i = F.col("event_id")
    y, m, d = F.year("ts"), F.month("ts"), F.dayofmonth("ts")
    start = (F.when(i % 10 == 0, F.format_string("%04d-%02d-%02d", y, m + 12, d))
             .when(i % 10 == 1, F.format_string("%04d-02-%02d", y, 29 + i % 3))
             .when(i % 10 == 2, F.format_string("%04d-02-29", y - 1))
             .when(i % 10 == 3, F.format_string("%04d-%02d-%02d", y + 5, m, d))
             .when(i % 10 == 4, F.format_string("%d-%d-%d", y, m, d))
             .when(i % 10 == 5, F.lit(None).cast("string"))
             .otherwise(F.col("ts").cast("date").cast("string")))
    day = F.to_date("ts")
    end = (F.when(i % 4 == 0, F.lit(None).cast("string"))
           .when(i % 4 == 1, F.lit("soon"))
           .when(i % 4 == 2, F.date_format(F.date_add(day, (i % 5).cast("int")), "yyyy-MM-dd"))
           .otherwise(F.date_format(F.date_sub(day, 2), "yyyy-MM-dd")))
    server = F.when(i % 23 != 0, F.format_string("sense%d", (F.col("user_id") % N_SERVERS).cast("int")))
    return ev.select(i.alias("request_id"), server.alias("server"),
                     start.alias("start_date"), end.alias("end_date"))


def daily_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-server samples pre-aggregated per (server, day): the data side of
    request joins."""
    s = metric_samples(spark, sf_dir).where(F.col("server").isNotNull())
    return s.groupBy("server", "day").agg(F.count(F.lit(1)).alias("n_samples"),
                                          F.sum("value").alias("total"))
