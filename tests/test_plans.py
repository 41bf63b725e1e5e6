"""Plan tests over every registered query: shapes that do not scale are absent."""

import re

from rackpulse.plans import QUERIES

SF = "/root/testdata/sf0.001"

# Windows over tables that are already aggregated to a chart's rows (per-x
# positions, per-region values, chunk counts of distinct values) may meet in one
# task; a global aggregate may too, as each task sends its partial row only.
SINGLE_PARTITION_OK = {"stack_wiggle", "nested_intervals", "ordinal_code", "ordinal_bands", "stack_inside_out"}


def gathers_rows(plan: str) -> bool:
    """Whether an exchange brings more than partial sums into one task."""
    lines = [re.sub(r"^[\s:+\-|]*(\*\(\d+\) )?", "", x) for x in plan.split("\n")]
    return any("Exchange SinglePartition" in x and not re.match(r"(Hash|ObjectHash|Sort)Aggregate.*(partial_|functions=\[\])", below)
               for x, below in zip(lines, lines[1:]))


def test_no_unscalable_operators(spark):
    # planned as for large tables: with automatic broadcasts off, a remaining
    # BroadcastExchange would be a forced broadcast of data that may grow
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    bad = {}
    try:
        for name in sorted(QUERIES):
            plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            hits = [p for p in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                                "BroadcastExchange") if p in plan]
            if gathers_rows(plan) and name not in SINGLE_PARTITION_OK:
                hits.append("SinglePartition")
            if hits:
                bad[name] = hits
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert not bad, bad


def test_pushdown_and_pruning(spark):
    plan = QUERIES["relative_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the day range passes the samples aggregate and reaches the events scan
    # as bounds on ts (Parquet row-group skipping)
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l and "events.parquet" in l][0]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", scan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts,", scan)
    plan = QUERIES["shelf_report"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in scan and "props" not in scan


def test_top_k_per_group_is_limited_before_the_shuffle(spark):
    from rackpulse.operators.cluster import first_k_centers
    from rackpulse.plans.q_cluster import _points
    plan = first_k_centers(_points(spark, SF), ["server"], ["day", "rn"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_time_bounds_reach_the_scan(spark):
    for name in ("fresh_rows", "day_select", "month_tail_select"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        scan = [x for x in plan.split("\n") if "FileScan parquet" in x and "events.parquet" in x][0]
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", scan), (name, scan)
