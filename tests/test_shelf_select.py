"""Shelf-log parsing (F6 cases) and selection rules (F7, F8 cases)."""

import datetime as dt

from pyspark.sql import functions as F

from rackpulse.operators import selection as S
from rackpulse.operators import shelf

LINES = [
    ("d/a", 1, "sense3 Shelf sdiskA1-rear temp 31 C"),      # both parts
    ("d/a", 2, "sense3 Shelf sdiskB2-front ok"),            # shelf only
    ("d/a", 3, "sense3 Shelf temp 40 C"),                   # temperature only
    ("d/a", 4, "sense3 Status sdiskA1-rear temp 33 C"),     # no Shelf
    ("d/a", 5, "sense3 Shelf sdiskC3-front temp 100 C"),    # 100 C reads as 00
    ("d/a", 6, "sense3 Shelf sdiskC3-front temp 9 C"),      # one digit: no match
    ("d/b", 7, "sense12 Shelf sdiskD1-rear temp 25 C"),     # sense12 -> sense1
]


def _lines(spark):
    return spark.createDataFrame(LINES, "dir string, line_id int, value string").withColumn("path", F.col("dir"))


def test_extract_parity_patterns(spark):
    got = sorted((r.line_id, r.shelf, r.temp_c, r.server) for r in shelf.extract_shelf(_lines(spark)).collect())
    assert got == [(1, "sdiskA1-rear", 31, "sense3"), (5, "sdiskC3-front", 0, "sense3"),
                   (7, "sdiskD1-rear", 25, "sense1")]


def test_extract_wide_patterns(spark):
    got = sorted((r.line_id, r.temp_c, r.server) for r in shelf.extract_shelf(_lines(spark), wide=True).collect())
    assert got == [(1, 31, "sense3"), (5, 100, "sense3"), (6, 9, "sense3"), (7, 25, "sense12")]


def test_report_two_grains(spark):
    p = shelf.extract_shelf(_lines(spark))
    rep = {(r.dir, r.shelf): (r.level, r.n_logs, r.mean_temp) for r in shelf.shelf_report(p).collect()}
    assert rep[("d/a", None)] == (1, 2, 15.5)
    assert rep[("d/a", "sdiskA1-rear")] == (0, 1, 31.0)
    assert rep[("d/b", None)] == (1, 1, 25.0)
    assert [r.server_name for r in shelf.server_name(_lines(spark)).orderBy("dir").collect()] == ["sense3", "sense1"]


def test_valid_date_cases(spark):
    cases = {"2014-02-29": False, "2012-02-29": True, "2014-13-01": False, "2014-00-10": False,
             "2014-7-1": False, "2031-01-01": False, "2014-07-09": True, "": False, None: False,
             "2014-07-09x": False}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.ok for r in df.select("s", S.valid_date(F.col("s"), F.lit("2024-06-01").cast("date")).alias("ok")).collect()}
    assert got == cases


def test_request_modes_and_days(spark):
    req = spark.createDataFrame([
        (1, "sense0", "2014-07-01", "2014-07-03"), (2, "sense0", "2014-07-01", None),
        (3, "sense0", "2014-07-01", "bad"), (4, None, "2014-07-01", None), (5, "sense0", "2014-13-01", None),
        (6, "sense0", "2014-07-05", "2014-07-01"), (7, "sense0", None, None)],
        "request_id int, server string, start_date string, end_date string")
    m = S.request_mode(req, F.lit("2024-01-01").cast("date"))
    modes = {r.request_id: r.mode for r in m.collect()}
    assert modes == {1: "range", 2: "single", 3: "single", 4: "reject", 5: "reject", 6: "range", 7: "reject"}
    assert {r.request_id: r.mode for r in S.request_mode(req, F.lit("2024-01-01").cast("date"), cli=True)
            .collect()}[7] == "whole"
    days = sorted((r.request_id, str(r.day)) for r in S.request_days(m).collect())
    assert days == [(1, "2014-07-01"), (1, "2014-07-02"), (1, "2014-07-03"), (2, "2014-07-01"), (3, "2014-07-01")]


def test_contiguous_range_stops_at_gap(spark):
    d = dt.date
    cat = spark.createDataFrame([
        (0, d(2014, 7, 1), "/s0/2014-07-01-10-00"), (0, d(2014, 7, 1), "/s0/2014-07-01-09-00"),
        (0, d(2014, 7, 2), "/s0/2014-07-02-10-00"), (0, d(2014, 7, 4), "/s0/2014-07-04-10-00"),
        (1, d(2014, 7, 2), "/s1/2014-07-02-10-00")], "server int, day date, path string")
    got = sorted((r.server, r.path) for r in S.contiguous_range(cat, "2014-07-01", "2014-07-05").collect())
    assert got == [(0, "/s0/2014-07-01-09-00"), (0, "/s0/2014-07-02-10-00")]
    assert [r.name for r in S.output_name(S.contiguous_range(cat, "2014-07-01", "2014-07-05")).collect()] == \
        ["2014-07-01_07-02_sense0"]
    assert S.contiguous_range(cat, "2014-07-01", "2014-07-05", contiguous=False).count() == 4


def test_month_tail_and_day_select(spark):
    cat = spark.createDataFrame([("/x/2014-06-08-10-00",), ("/x/2014-06-09-10-00",), ("/x/2014-06-07-10-00",),
                                 ("/x/201406/2014-06-20-13-00",), ("/x/2014-07-09-10-00",)], "path string")
    got = sorted(r.path for r in S.month_tail(cat, "20140608").collect())
    assert got == ["/x/2014-06-08-10-00", "/x/2014-06-09-10-00", "/x/201406/2014-06-20-13-00"]
    assert [r.path for r in S.select_day(cat, "2014-06-09").collect()] == ["/x/2014-06-09-10-00"]


def test_clean_name_cases(spark):
    df = spark.createDataFrame([("a/b/ 12:30:01 ",), ("plain",), ("dir/x:y",)], "p string")
    assert [r.c for r in df.select(S.clean_name(F.col("p")).alias("c")).collect()] == ["12-30-01", "plain", "x-y"]


def test_fresh_boundary(spark):
    df = spark.createDataFrame([(1, 1000), (2, 7999), (3, 799), (4, 800)], "id int, t long")
    got = sorted(r.id for r in S.fresh(df, "t", F.lit(8000), 7200).collect())
    assert got == [1, 2, 4]   # exactly 7200 s old is still fresh; 7201 s is not


def test_wide_numbers_beyond_an_int_are_dropped(spark):
    df = spark.createDataFrame([("sense3 Shelf sdiskA1-rear temp 99999999999999 C",), ("sense3 Shelf sdiskA1-rear temp 12 C",)], "value string")
    assert [r.temp_c for r in shelf.extract_shelf(df, wide=True).collect()] == [12]


def test_month_tail_skips_other_names(spark):
    import datetime as dt

    from rackpulse.operators.selection import month_tail
    d = dt.date(2014, 7, 20)
    df = spark.createDataFrame([("/2014-07/readme.txt", d), ("/x/2014-07-20-10-00", d), ("/x/2014-07-02-10-00", dt.date(2014, 7, 2))], "path string, day date")
    assert [r.path for r in month_tail(df, "20140715").collect()] == ["/x/2014-07-20-10-00"]
