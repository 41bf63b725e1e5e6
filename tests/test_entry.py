"""Driver contract: entry(), queries() and oracle_sql(); every query against
its DuckDB oracle on sf0.001 (row count, column names, rounded values)."""

import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def _digest():
    spec = importlib.util.spec_from_file_location("oracle_check", os.path.join(ROOT, "tools", "oracle_check.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m.digest


def test_entry_and_registry(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.count() > 0
    assert df.columns == ["server", "day", "rn", "time", "filewrites", "filereads", "CPU", "diskIOBW",
                          "net_bytes", "complete"]
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_every_query_matches_oracle(spark):
    m = _entry_module()
    digest = _digest()
    con = duckdb.connect()
    from rackpulse.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name, fn in sorted(m.queries().items()):
        df = fn(spark, SF)
        rows = df.collect()
        sql = m.oracle_sql().get(name)
        if sql is None:
            continue
        cur = con.execute(sql)
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        if sorted(df.columns) != sorted(ocols) or digest(df.columns, rows)[0] != digest(ocols, orows)[0]:
            bad.append(name)
    assert not bad


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_results_do_not_depend_on_session_time_zone(spark):
    """The driver runs queries() in its own session; days, epochs and week
    numbers must not move with spark.sql.session.timeZone."""
    m = _entry_module()
    digest = _digest()
    names = ["aligned_metrics", "relative_range", "day_backfill", "week_of_year", "day_select", "valid_date",
             "gap_interpolate"]
    tz = spark.conf.get("spark.sql.session.timeZone")

    def run():
        out = {}
        for n in names:
            df = m.queries()[n](spark, SF)
            out[n] = digest(df.columns, df.collect())[0]
        return out

    base = run()
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        shifted = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    assert shifted == base
