"""Selection of data by day, freshness and job request (S3-S5, S9-S12, S14, K2,
K5, F2, P7, P8, J4, W3).

The original lists a directory and loops over names on the driver; here the
listing is a table (``path``, ``server``, ``day``, ``modified``), so each rule
is a filter, aggregate or small window that prunes partitions when the data is
written partitioned by ``server`` and ``day``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import text

DATE_RE = r"^\d{4}-\d{2}-\d{2}$"


def stamp_name(ts: Column) -> Column:
    """file name of a collection time, ``yyyy-MM-dd-HH-mm``."""
    return F.format_string("%04d-%02d-%02d-%02d-%02d", F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts))


def file_catalog(events: DataFrame, root: str = "/data/metrics", raw_root: str = "/data/raw") -> DataFrame:
    """A listing of per-server metric files derived from ``events``: one file per
    (user as server, day, half day), named by its first time stamp. Days
    without events have no file, so ranges have gaps as real listings do."""
    part = F.floor(F.hour("ts") / 12).cast("int")
    g = (events.select("user_id", "ts", F.to_date("ts").alias("day"), part.alias("part"))
         .groupBy(F.col("user_id").alias("server"), "day", "part")
         .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("modified"),
              F.count(F.lit(1)).alias("n_rows")))
    name = stamp_name(F.col("first_ts"))
    return g.select(
        "server", "day", "part", name.alias("name"),
        F.format_string(f"{root}/sense%d/%s", F.col("server"), name).alias("path"),
        F.format_string(f"{raw_root}/sense%d/ %s ", F.col("server"), text(F.col("first_ts"))).alias("raw_path"),
        "modified", "n_rows")


def clean_name(path: Column) -> Column:
    """Base name, trimmed, colons replaced by dashes."""
    return F.translate(F.trim(F.element_at(F.split(path, "/"), -1)), ":", "-")


def relative_range(df: DataFrame, ts_day: str, anchor: Column, start_days_ago: int,
                   end_days_ago: int = 0) -> DataFrame:
    """S3: rows with ``anchor - N <= day < anchor - M`` (M = 0: no upper bound).

    ``anchor`` is a date column or literal (a parameter, so runs repeat)."""
    cond = F.col(ts_day) >= F.date_sub(anchor, start_days_ago)
    if end_days_ago > 0:
        cond = cond & (F.col(ts_day) < F.date_sub(anchor, end_days_ago))
    return df.where(cond)


def day_spine(anchor_df: DataFrame, start_days_ago: int, end_days_ago: int = 2) -> DataFrame:
    """The days N..M days before ``anchor`` (a one-row frame) as rows."""
    return anchor_df.select(F.explode(F.sequence(
        F.date_sub("anchor", start_days_ago), F.date_sub("anchor", end_days_ago))).alias("day"))


def select_day(catalog: DataFrame, day: str) -> DataFrame:
    """Every file whose name is the date plus six characters. A name's date
    is the file's ``day``; a catalog that has it is pruned by it."""
    named = F.col("path").rlike(f"/{day}.{{6}}")
    return catalog.where((F.col("day") == F.lit(day).cast("date")) & named if "day" in catalog.columns else named)


def contiguous_range(catalog: DataFrame, start: str, end: str, contiguous: bool = True) -> DataFrame:
    """Per server, the first file of each day from ``start`` to ``end``
    (inclusive), stopping at the first day without a file (gaps and islands:
    ``datediff(day, start) = rank - 1``)."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    firsts = (catalog.where((F.col("day") >= s) & (F.col("day") <= e))
              .groupBy("server", "day").agg(F.min("path").alias("path")))
    if not contiguous:
        return firsts
    w = Window.partitionBy("server").orderBy("day")
    return (firsts.withColumn("_rk", F.row_number().over(w))
            .where(F.datediff("day", s) == F.col("_rk") - 1).drop("_rk"))


def month_tail(catalog: DataFrame, start_yyyymmdd: str) -> DataFrame:
    """Files of the start's month (``YYYYMM`` or ``YYYY-MM`` in the path)
    whose day (two characters, eight from the end of the name) is not before
    the start day."""
    ym, ym_dash = start_yyyymmdd[:6], f"{start_yyyymmdd[:4]}-{start_yyyymmdd[4:6]}"
    day = int(start_yyyymmdd[6:8])
    fileday = F.substring(F.col("path"), -8, 2).try_cast("int")  # null: a name of another form
    named = (F.col("path").contains(ym) | F.col("path").contains(ym_dash)) & (fileday >= day)
    if "day" in catalog.columns:  # the month as days prunes the scan
        month = F.lit(ym_dash + "-01").cast("date")
        named = (F.col("day") >= month) & (F.col("day") < F.add_months(month, 1)) & named
    return catalog.where(named)


def fresh(df: DataFrame, t: str, now: Column, max_age_seconds: int = 7200) -> DataFrame:
    """Rows whose time is not older than ``max_age_seconds``. The column
    itself is compared (time stamps with a time stamp, epoch seconds with a
    number), so the bound reaches the scan."""
    seconds = str(df.schema[t].dataType) not in ("TimestampNTZType()", "TimestampType()")
    age = F.lit(max_age_seconds) if seconds else F.expr(f"INTERVAL {int(max_age_seconds)} SECONDS")
    return df.where(F.col(t) >= now - age)


def output_name(selected: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K5: ``yyyy-mm-dd_mm-dd_senseN`` from the first and last day used per
    server (or per ``by``, whose rows are of one server)."""
    by = by or ["server"]
    return (selected.groupBy(*by)
            .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min("server").alias("_server"))
            .select(*by, F.concat_ws("_", F.col("first_day").cast("string"),
                                          F.substring(F.col("last_day").cast("string"), 6, 5),
                                          F.format_string("sense%d", F.col("_server"))).alias("name")))


def valid_date(s: Column, asof: Column) -> Column:
    """``dddd-dd-dd``, a real calendar day, year not after ``asof``'s year."""
    d = F.try_to_date(s, "yyyy-MM-dd")
    return (F.coalesce(s.rlike(DATE_RE), F.lit(False)) & d.isNotNull()
            & (F.year(d) <= F.year(asof)))


def request_mode(requests: DataFrame, asof: Column, cli: bool = False) -> DataFrame:
    """``reject`` (no server, or missing or bad start), ``single`` (no or bad
    end), else ``range``. With ``cli`` a request without any date is ``whole``."""
    start_ok = valid_date(F.col("start_date"), asof)
    end_ok = valid_date(F.col("end_date"), asof)
    mode = F.when(F.col("server").isNull(), "reject")
    if cli:
        mode = mode.when(F.col("start_date").isNull() & F.col("end_date").isNull(), "whole")
    mode = (mode.when(F.col("start_date").isNull() | ~start_ok, "reject")
            .when(F.col("end_date").isNull() | ~end_ok, "single")
            .otherwise("range"))
    return requests.withColumn("mode", mode)


def request_days(requests: DataFrame) -> DataFrame:
    """The days each accepted request covers (start..end; one day for single).

    A request whose start is after its end covers no day."""
    s = F.to_date("start_date", "yyyy-MM-dd")
    e = F.when(F.col("mode") == "range", F.to_date("end_date", "yyyy-MM-dd")).otherwise(s)
    return (requests.where(F.col("mode").isin("single", "range"))
            .withColumn("_s", s).withColumn("_e", e)
            .where(F.col("_s") <= F.col("_e"))
            .withColumn("day", F.explode(F.sequence("_s", "_e")))
            .drop("_s", "_e"))


def request_range_join(requests: DataFrame, daily: DataFrame, whole: bool = False) -> DataFrame:
    """Requests x data with equal server and day between start and end.

    Each request is expanded to its days and joined on (server, day) with data
    pre-aggregated per server-day, so the join is an equi-join whose size is
    bounded by the requested days, never requests x samples. A ``whole`` request
    takes every day its server has."""
    dated = request_days(requests).join(daily, ["server", "day"])
    return dated.unionByName(requests.where(F.col("mode") == "whole").join(daily, "server")) if whole else dated
