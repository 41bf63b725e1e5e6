"""Registry of named queries: a Spark builder and, where SQL can say it, an
independent DuckDB query over the same Parquet tables.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame; doubles are
rounded to 6 places in both forms so that summation order cannot change the
comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# DuckDB form of ``tables.metric_samples`` shared by the telemetry oracles.
SAMPLES_CTE = """
samples AS (
  SELECT CASE WHEN event_type IN ('error', 'purchase', 'signup')
              THEN CAST(user_id % 7 AS INTEGER) END AS server,
         CASE event_type WHEN 'view' THEN 'filewrites' WHEN 'click' THEN 'filereads'
              WHEN 'error' THEN 'CPU' WHEN 'purchase' THEN 'diskIOBW'
              WHEN 'signup' THEN 'net_bytes' END AS metric,
         CAST(ts AS DATE) AS day,
         CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch,
         sum(value) AS value
  FROM events
  WHERE event_type IN ('view', 'click', 'error', 'purchase', 'signup')
  GROUP BY ALL)
"""
