"""Queries over scalar, time, collection, set and diff functions and the file
sources (F3-F14, P14-P22, J11, J12, U1-U3, O5, S15, S16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables as T
from ..functions import collections as CL
from ..functions import scales as SC
from ..functions import timefns as TF
from ..operators.diff import snapshot_diff
from ..session import scratch_path
from ..sources.metrics import coerce_numbers
from ..streaming.ingest import ingest_available, read_ingested
from .registry import query

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)
LINE_ORDER_DESC_SQL = ", ".join(c + " DESC" for c in LINE_ORDER)


def rb(c):
    return F.round(F.col(c) + 1e-9, 6).alias(c) if isinstance(c, str) else F.round(c + 1e-9, 6)


def _t(spark, sf_dir, name):
    return T.table(spark, sf_dir, name)


def _scratch(spark, what):
    return scratch_path(spark, what)


def _ordered_lines(spark, sf_dir, value_cols):
    """Per order, the lines' values in line order (at most a few per order)."""
    l = _t(spark, sf_dir, "lineitem")
    s = F.struct(*[F.col(c) for c in LINE_ORDER], *[F.col(c).alias("_v" + str(i)) for i, c in enumerate(value_cols)])
    return l.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(s)).alias("_lines"))


# ---- time --------------------------------------------------------------------

@query("time_floor", """
SELECT event_id,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS t_second,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS t_minute,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS t_hour,
       strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS t_day,
       strftime(CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER), '%Y-%m-%d 00:00:00') AS t_week,
       strftime(CAST(ts AS DATE) - CAST((dayofweek(ts) + 6) % 7 AS INTEGER), '%Y-%m-%d 00:00:00') AS t_week_mon,
       strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S') AS t_month,
       strftime(date_trunc('year', ts), '%Y-%m-%d %H:%M:%S') AS t_year
FROM events
""")
def q_time_floor(spark, sf_dir):
    ts = F.col("ts")
    cols = [("t_second", TF.floor_to(ts, "second")), ("t_minute", TF.floor_to(ts, "minute")),
            ("t_hour", TF.floor_to(ts, "hour")), ("t_day", TF.floor_to(ts, "day")),
            ("t_week", TF.floor_to(ts, "week", 0)), ("t_week_mon", TF.floor_to(ts, "week", 1)),
            ("t_month", TF.floor_to(ts, "month")), ("t_year", TF.floor_to(ts, "year"))]
    return _t(spark, sf_dir, "events").select("event_id", *[TF.text(c).alias(n) for n, c in cols])


@query("time_round", """
WITH b AS (SELECT event_id, ts, date_trunc('hour', ts) AS f,
                  date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS c,
                  date_trunc('day', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY AS dc FROM events)
SELECT event_id, strftime(c, '%Y-%m-%d %H:%M:%S') AS hour_ceil,
       strftime(CASE WHEN ts - f < c - ts THEN f ELSE c END, '%Y-%m-%d %H:%M:%S') AS hour_round,
       strftime(dc, '%Y-%m-%d %H:%M:%S') AS day_ceil
FROM b
""")
def q_time_round(spark, sf_dir):
    ts = F.col("ts")
    return _t(spark, sf_dir, "events").select(
        "event_id", TF.text(TF.ceil_to(ts, "hour")).alias("hour_ceil"),
        TF.text(TF.round_to(ts, "hour")).alias("hour_round"),
        TF.text(TF.ceil_to(ts, "day")).alias("day_ceil"))


@query("time_spine", """
WITH g AS (SELECT CAST(ts AS DATE) AS day, min(ts) AS t0, max(ts) AS t1 FROM events GROUP BY ALL),
c AS (SELECT day, date_trunc('hour', t0 - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS c0, t1 FROM g),
s AS (SELECT day, unnest(generate_series(c0, t1, INTERVAL 1 HOUR)) AS tick FROM c WHERE c0 <= t1)
SELECT day, strftime(tick, '%Y-%m-%d %H:%M:%S') AS tick FROM s WHERE hour(tick) % 3 = 0
""")
def q_time_spine(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    g = ev.groupBy(F.to_date("ts").alias("day")).agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    c = g.withColumn("c0", TF.ceil_to(F.col("t0"), "hour")).where(F.col("c0") <= F.col("t1"))
    s = c.select("day", F.explode(F.sequence("c0", "t1", F.expr("INTERVAL 1 HOUR"))).alias("tick"))
    return s.where(F.hour("tick") % 3 == 0).select("day", TF.text(F.col("tick")).alias("tick"))


@query("week_of_year", """
WITH e AS (SELECT event_id, dayofyear(ts) - 1 AS doy, dayofweek(date_trunc('year', ts)) AS first FROM events)
SELECT event_id, CAST((doy + first) // 7 AS INTEGER) AS week_sun, CAST((doy + (first + 6) % 7) // 7 AS INTEGER) AS week_mon,
       CAST(doy AS INTEGER) AS day_of_year
FROM e
""")
def q_week_of_year(spark, sf_dir):
    ts = F.col("ts")
    return _t(spark, sf_dir, "events").select(
        "event_id", TF.week_of_year(ts, 0).alias("week_sun"), TF.week_of_year(ts, 1).alias("week_mon"),
        (F.dayofyear(ts) - 1).cast("int").alias("day_of_year"))


@query("iso_time", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso,
       CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS epoch_ms
FROM events
""")
def q_iso_time(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", TF.iso_format(F.col("ts")).alias("iso"))
    back = TF.iso_parse(F.col("iso"))
    return ev.select("event_id", "iso", F.floor(TF.epoch_micros(back) / 1000).alias("epoch_ms"))


TIME_STEPS_SQL = ", ".join(f"({i}, {ms}, '{u}', {c})" for i, (ms, u, c) in enumerate(TF.TIME_STEPS))
#: Extents of all sizes: six-hour blocks of events, and from each order's date
#: on a span between 37 milliseconds and some thousand years.
SPANS_MS = [37, 420, 5000, 16000, 200000, 3000000, 30000000, 200000000, 3000000000, 50000000000, 600000000000, 6300000000000]


def _step_case(span: str) -> str:
    """The step 1, 2 or 5 x 10^k of about ten steps over a span, at least 1."""
    base = f"pow(10.0, floor(log10({span} / 10)))"
    err = f"(10 / ({span}) * {base})"
    return (f"greatest(1, CAST(trunc(CASE WHEN {err} <= 0.15 THEN {base} * 10 WHEN {err} <= 0.35 THEN {base} * 5 "
            f"WHEN {err} <= 0.75 THEN {base} * 2 ELSE {base} END) AS INTEGER))")


@query("time_scale_ticks", f"""
WITH g AS (
  SELECT 'events' AS kind, CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) // 21600 AS BIGINT) + hour(ts) // 6 AS id, min(ts) AS t0, max(ts) AS t1
  FROM events GROUP BY ALL
  UNION ALL
  SELECT 'orders', o_orderkey, o_orderdate,
         o_orderdate + to_milliseconds([{', '.join(map(str, SPANS_MS))}][o_orderkey % 12 + 1]::BIGINT * (1 + o_orderkey % 7)) FROM orders),
steps(i, ms, unit, cnt) AS (VALUES {TIME_STEPS_SQL}),
c AS (SELECT *, (epoch_us(t1) - epoch_us(t0)) / 1000.0 AS span_ms, (epoch_us(t1) - epoch_us(t0)) / 1000.0 / 10 AS target,
             (SELECT count(*) FROM steps WHERE ms <= (epoch_us(t1) - epoch_us(t0)) / 1000.0 / 10) AS idx FROM g WHERE t1 > t0),
p AS (SELECT c.*, CASE WHEN target / lo.ms < hi.ms / target THEN idx - 1 ELSE idx END AS si
      FROM c LEFT JOIN steps lo ON lo.i = idx - 1 LEFT JOIN steps hi ON hi.i = idx),
u AS (SELECT p.kind, p.id, p.t0, p.t1, t0 - INTERVAL 1 MICROSECOND AS before,
             CASE WHEN idx = 0 THEN 'millisecond' WHEN idx = 18 THEN 'year' ELSE s.unit END AS unit,
             CASE WHEN idx = 0 THEN {_step_case("span_ms")} WHEN idx = 18 THEN {_step_case("(span_ms / 31536e6)")} ELSE s.cnt END AS cnt
      FROM p LEFT JOIN steps s ON s.i = p.si),
v AS (SELECT *, CASE unit WHEN 'millisecond' THEN make_timestamp(CAST(floor(epoch_us(before) / (cnt * 1000.0)) * cnt * 1000 AS BIGINT))
                          WHEN 'year' THEN make_timestamp(CAST(floor(year(before) / cnt) * cnt AS BIGINT), 1, 1, 0, 0, 0)
                          WHEN 'week' THEN CAST(CAST(before AS DATE) - CAST(dayofweek(before) AS INTEGER) AS TIMESTAMP)
                          ELSE date_trunc(unit, before) END AS c0,
             CASE unit WHEN 'millisecond' THEN to_milliseconds(cnt) WHEN 'second' THEN to_seconds(1) WHEN 'minute' THEN to_minutes(1)
                       WHEN 'hour' THEN to_hours(1) WHEN 'day' THEN to_days(1) WHEN 'week' THEN to_days(7) WHEN 'month' THEN to_months(1)
                       ELSE to_years(CAST(cnt AS INTEGER)) END AS step FROM u),
t AS (SELECT kind, id, unit, cnt, t0, unnest(generate_series(c0, t1, step)) AS tick FROM v)
SELECT kind, id, unit, CAST(cnt AS INTEGER) AS step_count, CAST(epoch_us(tick) // 1000 AS BIGINT) AS tick_ms
FROM t
WHERE tick >= t0
  AND (CASE unit WHEN 'millisecond' THEN epoch_us(tick) // 1000 WHEN 'second' THEN second(tick) WHEN 'minute' THEN minute(tick)
                 WHEN 'hour' THEN hour(tick) WHEN 'day' THEN day(tick) - 1 WHEN 'week' THEN 0 WHEN 'month' THEN month(tick) - 1 ELSE year(tick) END) % cnt = 0
""")
def q_time_scale_ticks(spark, sf_dir):
    """P20 over extents of every unit, from milliseconds to many years."""
    block = F.floor(TF.epoch_micros(F.col("ts")) / 21_600_000_000)
    events = (_t(spark, sf_dir, "events").groupBy(F.lit("events").alias("kind"), block.alias("id"))
              .agg(F.min("ts").alias("t0"), F.max("ts").alias("t1")))
    size = F.element_at(F.array(*[F.lit(x).cast("long") for x in SPANS_MS]), (F.col("o_orderkey") % 12 + 1).cast("int")) * (1 + F.col("o_orderkey") % 7)
    orders = _t(spark, sf_dir, "orders").select(
        F.lit("orders").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("t0"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(size / 1000).cast("decimal(18,6)"))).alias("t1"))
    t = TF.ticks(events.unionByName(orders), "t0", "t1", 10)
    return t.select("kind", "id", "unit", F.col("step_count").cast("int").alias("step_count"), F.floor(TF.epoch_micros(F.col("tick")) / 1000).alias("tick_ms"))


# ---- collections ---------------------------------------------------------------

@query("number_range", """
SELECT p_partkey, CAST(unnest(range(0, p_size, 5)) AS INTEGER) AS v FROM part
""")
def q_number_range(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", F.explode(CL.number_range(F.lit(0), F.col("p_size"), F.lit(5))).alias("v"))


@query("transpose", f"""
WITH m AS (SELECT l_orderkey, {LINE_ORDER_SQL}, 0 AS j, CAST(l_linenumber AS INTEGER) AS v FROM lineitem
           UNION ALL SELECT l_orderkey, {LINE_ORDER_SQL}, 1, CAST(trunc(l_quantity) AS INTEGER) FROM lineitem
           UNION ALL SELECT l_orderkey, {LINE_ORDER_SQL}, 2, CAST(l_suppkey % 100 AS INTEGER) FROM lineitem)
SELECT l_orderkey, j, string_agg(CAST(v AS VARCHAR), ',' ORDER BY {LINE_ORDER_SQL}) AS vals
FROM m GROUP BY l_orderkey, j
""")
def q_transpose(spark, sf_dir):
    g = _ordered_lines(spark, sf_dir, ["l_linenumber", "l_quantity", "l_suppkey"])
    rows = F.transform("_lines", lambda s: F.array(s["_v0"].cast("int"), s["_v1"].cast("int"),
                                                   (s["_v2"] % 100).cast("int")))
    # posexplode twice (row, column), then one array per column in row order
    cells = g.select("l_orderkey", F.posexplode(rows).alias("i", "_row")) \
        .select("l_orderkey", "i", F.posexplode("_row").alias("j", "v"))
    t = cells.groupBy("l_orderkey", "j").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("_c"))
    return t.select("l_orderkey", "j", F.array_join(F.transform("_c", lambda s: s["v"].cast("string")), ",")
                    .alias("vals"))


@query("permute_array", f"""
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY {LINE_ORDER_DESC_SQL}) AS permuted
FROM lineitem GROUP BY l_orderkey
""")
def q_permute_array(spark, sf_dir):
    g = _ordered_lines(spark, sf_dir, ["l_partkey"])
    arr = F.transform("_lines", lambda s: s["_v0"])
    idx = F.sequence(F.size(arr) - 1, F.lit(0), F.lit(-1))
    return g.select("l_orderkey", F.array_join(CL.permute(arr, idx).cast("array<string>"), ",").alias("permuted"))


@query("zip_shortest", f"""
WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS r,
                  count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT l_orderkey, CAST(r - 1 AS INTEGER) AS i, l_partkey AS a, CAST(r AS BIGINT) AS b
FROM r WHERE r <= least(n, l_orderkey % 4 + 1)
""")
def q_zip_shortest(spark, sf_dir):
    g = _ordered_lines(spark, sf_dir, ["l_partkey"])
    a = F.transform("_lines", lambda s: s["_v0"])
    b = F.sequence(F.lit(1).cast("long"), F.col("l_orderkey") % 4 + 1)
    z = g.select("l_orderkey", F.posexplode(CL.zip_shortest(a, b)).alias("i", "_z"))
    return z.select("l_orderkey", "i", F.col("_z.a").alias("a"), F.col("_z.b").cast("long").alias("b"))


@query("flatten_arrays", f"""
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY {LINE_ORDER_SQL}) || ',' ||
                   string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY {LINE_ORDER_SQL}) AS merged
FROM lineitem GROUP BY l_orderkey
""")
def q_flatten_arrays(spark, sf_dir):
    g = _ordered_lines(spark, sf_dir, ["l_partkey", "l_suppkey"])
    m = CL.merge_arrays(F.transform("_lines", lambda s: s["_v0"]), F.transform("_lines", lambda s: s["_v1"]))
    return g.select("l_orderkey", F.array_join(m.cast("array<string>"), ",").alias("merged"))


@query("distinct_set", """
SELECT l_orderkey, CAST(count(DISTINCT l_suppkey % 10) AS INTEGER) AS n_distinct FROM lineitem GROUP BY l_orderkey
""")
def q_distinct_set(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem")
    return l.groupBy("l_orderkey").agg(
        F.size(F.collect_set(F.col("l_suppkey") % 10)).alias("n_distinct"))


@query("map_parts", """
WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS INTEGER) AS value FROM k
""")
def q_map_parts(spark, sf_dir):
    m = F.from_json("props", "map<string,int>")
    ev = _t(spark, sf_dir, "events").select("event_id", m.alias("m"))
    return ev.select("event_id", F.explode(F.map_entries("m")).alias("_e")) \
        .select("event_id", F.col("_e.key").alias("key"), F.col("_e.value").alias("value"))


@query("map_ops", """
SELECT event_id, json_exists(props, '$.k') AS has_k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS get_k,
       CAST(len(json_keys(props)) + 1 AS INTEGER) AS n_after_set,
       CAST(len(json_keys(props)) - CASE WHEN json_exists(props, '$.k') THEN 1 ELSE 0 END AS INTEGER)
         AS n_after_remove
FROM events
""")
def q_map_ops(spark, sf_dir):
    m = F.from_json("props", "map<string,int>")
    ev = _t(spark, sf_dir, "events").select("event_id", m.alias("m"))
    return ev.select(
        "event_id", F.map_contains_key("m", "k").alias("has_k"), F.col("m").getItem("k").alias("get_k"),
        F.size(F.map_concat("m", F.create_map(F.lit("src"), F.lit(1)))).alias("n_after_set"),
        F.size(F.map_filter("m", lambda k, v: k != "k")).alias("n_after_remove"))


@query("random_columns")
def q_random_columns(spark, sf_dir):
    """normal, log-normal, Bates (mean of 3 uniforms), Irwin-Hall (sum of 3)."""
    ev = _t(spark, sf_dir, "events").select("event_id")
    return ev.select("event_id", F.randn(42).alias("normal"), F.exp(F.randn(43)).alias("log_normal"),
                     ((F.rand(1) + F.rand(2) + F.rand(3)) / 3).alias("bates"),
                     (F.rand(4) + F.rand(5) + F.rand(6)).alias("irwin_hall"))


@query("random_column_checks", """
SELECT * FROM (VALUES ('bates', true, true, true), ('irwin_hall', true, true, true), ('log_normal', true, true, true), ('normal', true, true, true))
  t(name, mean_ok, spread_ok, range_ok)
""")
def q_random_column_checks(spark, sf_dir):
    """each column's mean and spread lie within six standard errors of the
    distribution's own (the log of the log-normal: of the normal's), and its
    values in its range."""
    d = q_random_columns(spark, sf_dir)
    names = {"normal": (F.col("normal"), 0.0, 1.0, None), "log_normal": (F.log("log_normal"), 0.0, 1.0, (0.0, float("inf"))),
             "bates": (F.col("bates"), 0.5, (1 / 36) ** 0.5, (0.0, 1.0)), "irwin_hall": (F.col("irwin_hall"), 1.5, 0.5, (0.0, 3.0))}
    parts = []
    for name, (x, mean, sd, bounds) in names.items():
        error = 6 * sd / F.sqrt(F.count("*"))
        inside = F.lit(True) if bounds is None else F.every((F.col(name) >= bounds[0]) & (F.col(name) <= bounds[1]))
        parts.append(F.struct(F.lit(name).alias("name"), (F.abs(F.avg(x) - mean) < error).alias("mean_ok"),
                              (F.abs(F.stddev(x) - sd) < error * 2).alias("spread_ok"), inside.alias("range_ok")))
    return d.agg(F.array(*parts).alias("c")).select(F.inline("c"))


# ---- scales --------------------------------------------------------------------

@query("piecewise_scale", """
WITH s AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS x,
                  CASE WHEN l_extendedprice >= 10000 THEN 1 ELSE 0 END AS seg FROM lineitem),
y AS (SELECT *, CASE WHEN seg = 0 THEN 0.0 + ((x - 0.0) / (10000.0 - 0.0)) * 0.5
                     ELSE 0.5 + ((x - 10000.0) / (100000.0 - 10000.0)) * 0.5 END AS y FROM s)
SELECT l_orderkey, l_linenumber, round(y + 1e-9, 6) AS y,
       round(greatest(0.0, least(1.0, y)) + 1e-9, 6) AS y_clamped,
       round(0.0 + ((0.0 + ((x - 0.0) / (100000.0 - 0.0)) * 1.0) - 0.0) / 1.0 * (100000.0 - 0.0) + 1e-9, 6)
         AS x_back
FROM y
""")
def q_piecewise_scale(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem")
    y = SC.piecewise(F.col("l_extendedprice"), [0, 10000, 100000], [0, 0.5, 1])
    yc = SC.piecewise(F.col("l_extendedprice"), [0, 10000, 100000], [0, 0.5, 1], clamp=True)
    back = SC.invert(SC.linear(F.col("l_extendedprice"), 0.0, 100000.0, 0, 1), 0.0, 100000.0, 0, 1)
    return l.select("l_orderkey", "l_linenumber", rb(y).alias("y"), rb(yc).alias("y_clamped"),
                    rb(back).alias("x_back"))


@query("log_pow_scale", """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT o_orderkey,
       round(CASE WHEN log10(e.hi) = log10(e.lo) THEN 0.0
                  ELSE 0.0 + ((log10(o_totalprice) - log10(e.lo)) / (log10(e.hi) - log10(e.lo))) * 1.0 END
             + 1e-9, 6) AS log_y,
       round(0.0 + ((sign(o_totalprice) * pow(abs(o_totalprice), 0.5) - 0.0)
                    / (sign(e.hi) * pow(abs(e.hi), 0.5) - 0.0)) * 1.0 + 1e-9, 6) AS sqrt_y
FROM orders, e
""")
def q_log_pow_scale(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    ext = o.select(F.struct(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))).scalar()
    d = o.select("o_orderkey", "o_totalprice", ext.alias("_e"))
    x, lo, hi = F.col("o_totalprice"), F.col("_e.lo"), F.col("_e.hi")
    return d.select("o_orderkey", rb(SC.log_scale(x, lo, hi, 0, 1)).alias("log_y"),
                    rb(SC.pow_scale(x, 0.0, hi, 0, 1, 0.5)).alias("sqrt_y"))


THRESHOLDS = [50000, 100000, 200000, 300000]
THR_SQL = " + ".join(f"(o_totalprice >= {t})::INT" for t in THRESHOLDS)


@query("threshold_bucket", f"""
SELECT o_orderkey, CAST({THR_SQL} AS INTEGER) AS bucket FROM orders
""")
def q_threshold_bucket(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", SC.threshold(F.col("o_totalprice"), THRESHOLDS).alias("bucket"))


@query("bucket_bounds", f"""
WITH b AS (SELECT CAST({THR_SQL} AS INTEGER) AS bucket FROM orders)
SELECT bucket,
       CASE bucket {" ".join(f"WHEN {i + 1} THEN CAST({t} AS DOUBLE)" for i, t in enumerate(THRESHOLDS))} END AS lo,
       CASE bucket {" ".join(f"WHEN {i} THEN CAST({t} AS DOUBLE)" for i, t in enumerate(THRESHOLDS))} END AS hi,
       count(*) AS n
FROM b GROUP BY bucket
""")
def q_bucket_bounds(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    b = o.select(SC.threshold(F.col("o_totalprice"), THRESHOLDS).alias("bucket")) \
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    lo, hi = SC.bucket_bounds(F.col("bucket"), THRESHOLDS)
    return b.select("bucket", lo.alias("lo"), hi.alias("hi"), "n")


BISECT_LIST = [10, 20, 20, 30, 40]


@query("bisect", f"""
SELECT l_orderkey, l_linenumber, l_quantity,
       CAST({" + ".join(f"({t} < l_quantity)::INT" for t in BISECT_LIST)} AS INTEGER) AS bisect_left,
       CAST({" + ".join(f"({t} <= l_quantity)::INT" for t in BISECT_LIST)} AS INTEGER) AS bisect_right
FROM lineitem
""")
def q_bisect(spark, sf_dir):
    from ..operators.stats import bisect_left, bisect_right
    arr = F.array(*[F.lit(float(t)) for t in BISECT_LIST])
    l = _t(spark, sf_dir, "lineitem")
    return l.select("l_orderkey", "l_linenumber", "l_quantity",
                    bisect_left(F.col("l_quantity"), arr).alias("bisect_left"),
                    bisect_right(F.col("l_quantity"), arr).alias("bisect_right"))


@query("round_half_up", """
SELECT l_orderkey, l_linenumber, floor(l_extendedprice * l_discount * 100.0 + 0.5) / 100.0 AS half_up
FROM lineitem
""")
def q_round_half_up(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem")
    return l.select("l_orderkey", "l_linenumber",
                    SC.round_half_up(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("half_up"))


SI_LIST_SQL = "[" + ", ".join(f"'{s}'" for s in SC.SI_SYMBOLS) + "]"


@query("si_prefix", f"""
WITH v AS (SELECT l_orderkey, l_linenumber,
                  l_extendedprice * pow(10.0, (l_linenumber - 4) * 3) AS x FROM lineitem),
e AS (SELECT *, CASE WHEN abs(x) = 0 THEN 0 ELSE CAST(greatest(-24, least(24,
              floor((1 + floor(1e-12 + ln(abs(x)) / ln(10.0)) - 1) / 3) * 3)) AS INTEGER) END AS exponent
      FROM v)
SELECT l_orderkey, l_linenumber, exponent, {SI_LIST_SQL}[CAST(exponent / 3 + 9 AS INTEGER)] AS symbol,
       round(x * pow(10.0, -exponent) + 1e-9, 6) AS scaled
FROM e
""")
def q_si_prefix(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice") * F.pow(F.lit(10.0), (F.col("l_linenumber") - 4) * 3)
    e, sym, scaled = SC.si_prefix(x)
    return l.select("l_orderkey", "l_linenumber", e.alias("exponent"), sym.alias("symbol"), rb(scaled).alias("scaled"))


@query("ordinal_bands", """
WITH f AS (SELECT p_brand, min(p_partkey) AS first_pos FROM part GROUP BY p_brand),
c AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY first_pos, p_brand) - 1 AS INTEGER) AS code,
             count(*) OVER () AS n FROM f)
SELECT p_brand, code,
       round(CASE WHEN n > 1 THEN 0.0 + (600.0 / (n - 1 + 1.0)) * 0.5 + (600.0 / (n - 1 + 1.0)) * code
                  ELSE 300.0 END + 1e-9, 6) AS point,
       round(0.0 + (600.0 / (n - 0.1 + 0.4)) * 0.2 + (600.0 / (n - 0.1 + 0.4)) * code + 1e-9, 6) AS band_x,
       round((600.0 / (n - 0.1 + 0.4)) * 0.9 + 1e-9, 6) AS band_w
FROM c
""")
def q_ordinal_bands(spark, sf_dir):
    from ..operators.view import ordinal_codes
    codes = ordinal_codes(_t(spark, sf_dir, "part"), "p_brand", "p_partkey")
    n = codes.select(F.count(F.lit(1))).scalar()
    bx, bw = SC.ordinal_bands(F.col("code"), n, 0, 600, 0.1, 0.2)
    return codes.select("p_brand", "code", rb(SC.ordinal_points(F.col("code"), n, 0, 600, 1.0)).alias("point"),
                        rb(bx).alias("band_x"), rb(bw).alias("band_w"))


# ---- diff and sets -----------------------------------------------------------

@query("snapshot_diff", """
WITH of AS (SELECT o_custkey AS k, min(o_orderkey) AS f FROM orders GROUP BY k)
SELECT coalesce(k, c_custkey) AS custkey,
       CASE WHEN f IS NULL THEN 'enter' WHEN c_custkey IS NULL THEN 'exit' ELSE 'update' END AS status,
       f AS old_id, c_custkey AS new_id
FROM of FULL JOIN customer ON k = c_custkey
UNION ALL
SELECT o_custkey, 'exit', o_orderkey, NULL FROM orders JOIN of ON o_custkey = k WHERE o_orderkey <> f
""")
def q_snapshot_diff(spark, sf_dir):
    """All orders, keyed by customer, against all customers: customers without
    orders enter, the first order of a customer is updated, its others exit."""
    old = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("id"))
    new = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_custkey").alias("id"))
    return snapshot_diff(old, new, "custkey", "id")


@query("union_all", """
SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM supplier
""")
def q_union_all(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"),
                                             F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    s = _t(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"),
                                             F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s)


@query("shuffle_rows", "SELECT o_orderkey FROM orders")
def q_shuffle_rows(spark, sf_dir):
    """A random permutation (range-partitioned sort on a seeded key)."""
    return _t(spark, sf_dir, "orders").select("o_orderkey").orderBy(F.rand(42))


# ---- file sources ---------------------------------------------------------------

JUNK_SQL = """CASE WHEN event_id % 50 = 0 THEN 'abc' WHEN event_id % 77 = 0 THEN ''
                   ELSE CAST(value AS VARCHAR) END"""


@query("csv_coerce", f"""
SELECT event_id, TRY_CAST({JUNK_SQL} AS DOUBLE) AS v FROM events
""")
def q_csv_coerce(spark, sf_dir):
    """Numbers written as text (with junk and blanks), read back from a
    header CSV as strings and coerced; junk and blanks become null."""
    ev = _t(spark, sf_dir, "events")
    junk = (F.when(F.col("event_id") % 50 == 0, F.lit("abc")).when(F.col("event_id") % 77 == 0, F.lit(""))
            .otherwise(F.col("value").cast("string")))
    path = _scratch(spark, "csv-coerce")
    ev.select("event_id", junk.alias("v")).write.option("header", True).csv(path)
    raw = spark.read.option("header", True).schema("event_id string, v string").csv(path)
    out = coerce_numbers(raw, ["v"])
    return out.select(F.col("event_id").cast("long").alias("event_id"), "v")


@query("incremental_ingest", """
SELECT event_id, event_type, value FROM events
""")
def q_incremental_ingest(spark, sf_dir):
    """Files arrive in two drops; each ingest run takes only new files."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    base = _scratch(spark, "ingest")
    src, dst, ck = f"{base}/source", f"{base}/target", f"{base}/checkpoint"
    first = ev.where(F.dayofmonth("ts") <= 15)
    first.write.mode("append").parquet(src)
    ingest_available(spark, src, dst, ck, first.schema)
    ev.where(F.dayofmonth("ts") > 15).write.mode("append").parquet(src)
    ingest_available(spark, src, dst, ck, first.schema)
    return read_ingested(spark, dst).select("event_id", "event_type", "value")
