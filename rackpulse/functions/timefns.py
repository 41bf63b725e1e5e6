"""Calendar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tick steps of a time scale in milliseconds, with the interval
# and count each stands for.
TIME_STEPS = [
    (1e3, "second", 1), (5e3, "second", 5), (15e3, "second", 15), (3e4, "second", 30),
    (6e4, "minute", 1), (3e5, "minute", 5), (9e5, "minute", 15), (18e5, "minute", 30),
    (36e5, "hour", 1), (108e5, "hour", 3), (216e5, "hour", 6), (432e5, "hour", 12),
    (864e5, "day", 1), (1728e5, "day", 2), (6048e5, "week", 1),
    (2592e6, "month", 1), (7776e6, "month", 3), (31536e6, "year", 1),
]

PARTS = ("year", "month", "day", "hour", "minute", "second")


def wall_clock(ts: Column, unit: str) -> Column:
    """A time stamp without zone whose parts below ``unit`` are at their
    start: its day (or the first of its month or year) and what the clock has
    passed, so no time zone (and no hour that a zone leaves out) comes into it."""
    day = F.to_date(ts)
    if unit in ("month", "year"):
        return F.trunc(day, unit).cast("timestamp_ntz")
    passed = [read(ts) for read in (F.hour, F.minute, F.second)][:PARTS.index(unit) - 2]
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), *passed) if passed else day.cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a time stamp without zone."""
    minutes = (F.unix_date(F.to_date(ts)).cast("long") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60000000 + (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("long")


def text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a time stamp without zone."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def floor_to(ts: Column, unit: str, week_start: int = 0) -> Column:
    """start of the second/minute/hour/day/week/month/year holding ``ts``.

    Weeks start on ``week_start`` (0 = Sunday, 1 = Monday, ...)."""
    if unit == "week":
        d = F.to_date(ts)
        back = F.pmod(F.dayofweek(d) - 1 - F.lit(week_start), F.lit(7))
        return F.date_sub(d, back.cast("int")).cast("timestamp_ntz")
    return wall_clock(ts, unit)


def ceil_to(ts: Column, unit: str) -> Column:
    """the smallest unit boundary at or after ``ts``."""
    f = floor_to(ts - F.expr("INTERVAL 1 MICROSECOND"), unit)
    return offset(f, unit, 1)


def offset(ts: Column, unit: str, k: int) -> Column:
    """``k`` units on. A day that the month reached lacks runs over into the
    next: 31 January and a month is 2 or 3 March."""
    if unit in ("month", "year"):
        day = F.to_date(ts)
        first = F.add_months(F.trunc(day, "month"), k * (12 if unit == "year" else 1))
        return F.date_add(first, F.dayofmonth(day) - 1).cast("timestamp_ntz") + (ts - day.cast("timestamp_ntz"))
    if unit == "week":
        return ts + F.expr(f"INTERVAL {7 * k} DAYS")
    return ts + F.expr(f"INTERVAL {k} {unit.upper()}S")


def round_to(ts: Column, unit: str) -> Column:
    """nearer of floor and ceil; an exact half goes up."""
    f, c = floor_to(ts, unit), ceil_to(ts, unit)
    return F.when((ts - f) < (c - ts), f).otherwise(c)


def week_of_year(ts: Column, week_start: int = 0) -> Column:
    """week number with weeks starting on ``week_start`` (0 Sunday, 1
    Monday); the week that holds 1 January is week 0, however short."""
    before = F.pmod(F.dayofweek(F.make_date(F.year(ts), F.lit(1), F.lit(1))) - 1 - F.lit(week_start), F.lit(7))
    return F.floor((F.dayofyear(ts) - 1 + before) / 7).cast("int")


def iso_format(ts: Column) -> Column:
    """ISO-8601 text with milliseconds and a ``Z``."""
    written = ts.cast("timestamp_ntz").cast("string")  # without a fraction that is zero
    return F.concat(F.substring(written, 1, 10), F.lit("T"), F.substring(written, 12, 8), F.lit("."), F.rpad(F.substring(written, 21, 3), 3, "0"), F.lit("Z"))


def iso_parse(s: Column) -> Column:
    """ISO text back to a timestamp (null when not ISO)."""
    return F.when(s.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$"),
                  F.substring(s, 1, 23).try_cast("timestamp_ntz"))


def linear_step(span: Column, m: int = 10) -> Column:
    """Step 1, 2 or 5 x 10^k giving about ``m`` steps over a positive span."""
    from ..operators.view import tick_step
    return tick_step(F.lit(0.0), span, m)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it stands in it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def interval(span_ms: Column, m: int = 10) -> Column:
    """P20: struct(unit, count) of the tick interval for a span and about ``m`` ticks:
    the listed step nearest to span / m by ratio. Below the first step ticks are
    milliseconds, from the last one on years, both in steps of 1, 2 or 5 x 10^k."""
    lows, units, counts = (F.array(*map(F.lit, x)) for x in zip(*TIME_STEPS))
    last = F.lit(len(TIME_STEPS))

    def chosen(span: Column, target: Column, above: Column) -> Column:
        low, high = F.element_at(lows, F.greatest(above, F.lit(1))), F.element_at(lows, F.least(above + 1, last))
        at = F.greatest(F.lit(1), F.when(target / low < high / target, above).otherwise(F.least(above + 1, last)))
        listed = F.struct(F.element_at(units, at).alias("unit"), F.element_at(counts, at).alias("count"))
        years = F.greatest(F.lit(1.0), linear_step(span / 31536e6, m)).cast("int")
        milliseconds = F.greatest(F.lit(1.0), linear_step(span, m)).cast("int")
        return (F.when(above == 0, F.struct(F.lit("millisecond").alias("unit"), milliseconds.alias("count")))
                .when(above == last, F.struct(F.lit("year").alias("unit"), years.alias("count"))).otherwise(listed))

    return _let(span_ms, lambda span: _let(span / F.lit(float(m)), lambda target: _let(
        F.size(F.filter(lows, lambda low: low <= target)), lambda above: chosen(span, target, above))))


def time_step(span_ms: Column, m: int = 10) -> tuple[Column, Column]:
    """``interval`` as (unit, count)."""
    found = interval(span_ms, m)
    return found.getField("unit"), found.getField("count")


def unit_number(ts: Column, unit: Column) -> Column:
    """Number used by the step filter of a range: milliseconds since 1970,
    seconds, minutes, hours of the clock, day of month - 1, the week (0: every
    week is taken), month - 1, or the year."""
    return (F.when(unit == "millisecond", F.floor(epoch_micros(ts) / 1000))
            .when(unit == "second", F.second(ts)).when(unit == "minute", F.minute(ts))
            .when(unit == "hour", F.hour(ts)).when(unit == "day", F.dayofmonth(ts) - 1)
            .when(unit == "week", F.lit(0))
            .when(unit == "month", F.month(ts) - 1).otherwise(F.year(ts)).cast("long"))


def ticks(df: DataFrame, t0: str, t1: str, m: int = 10) -> DataFrame:
    """P20: ``df`` with a row for each tick between its columns ``t0`` and
    ``t1`` (time stamps without zone): ``unit``, ``step_count`` and ``tick``.
    Rows without extent or without a tick give none.

    A row's candidates are the unit's boundaries in its range, of which the
    step filter keeps every ``step_count``-th; milliseconds and years are laid
    out in whole steps, so there are some ``10 m`` candidates at most."""
    d = df.where(F.col(t1) > F.col(t0)).withColumn("_span", (epoch_micros(F.col(t1)) - epoch_micros(F.col(t0))) / 1000.0)
    d = d.withColumn("_interval", interval(F.col("_span"), m))
    d = d.withColumn("unit", F.col("_interval.unit")).withColumn("step_count", F.col("_interval.count"))
    u, n = F.col("unit"), F.col("step_count")
    d = d.withColumn("_before", F.col(t0) - F.expr("INTERVAL 1 MICROSECOND"))
    before, zero = F.col("_before"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole_ms = F.floor(epoch_micros(before) / (n * 1000)) * n / 1000
    begin = F.when(u == "millisecond", zero + F.make_dt_interval(secs=whole_ms.cast("decimal(18,6)")))
    begin = begin.when(u == "year", F.make_timestamp_ntz((F.floor(F.year(before) / n) * n).cast("int"), *map(F.lit, (1, 1, 0, 0, 0))))
    for name in ("second", "minute", "hour", "day", "week"):
        begin = begin.when(u == name, floor_to(before, name))
    seconds = F.when(u == "millisecond", n / 1000)
    for name, size in (("second", 1), ("minute", 60), ("hour", 3600), ("day", 86400), ("week", 7 * 86400)):
        seconds = seconds.when(u == name, size)
    d = (d.withColumn("_begin", begin.otherwise(floor_to(before, "month")))
         .withColumn("_step", F.make_dt_interval(secs=seconds.cast("decimal(18,6)")))
         .withColumn("_months", F.make_ym_interval(F.when(u == "year", n).otherwise(0), F.when(u == "month", 1).otherwise(0))))
    every = F.when(u.isin("month", "year"), F.sequence("_begin", F.col(t1), F.col("_months"))).otherwise(F.sequence("_begin", F.col(t1), F.col("_step")))
    out = d.withColumn("tick", F.explode(every))
    kept = out.where((F.col("tick") >= F.col(t0)) & (unit_number(F.col("tick"), u) % n == 0))
    return kept.drop("_span", "_interval", "_before", "_begin", "_step", "_months")
