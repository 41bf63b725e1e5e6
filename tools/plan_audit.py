"""Audit the physical plans of all registered queries for shapes that do not
scale: cartesian products, nested-loop joins, single-partition exchanges,
windows without a partition key, row-at-a-time Python UDFs."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rackpulse.plans import QUERIES  # noqa: E402
from rackpulse.session import get_spark  # noqa: E402

PATTERNS = {
    "cartesian": r"CartesianProduct",
    "nested_loop": r"BroadcastNestedLoopJoin",
    "single_partition": r"Exchange SinglePartition",
    "unpartitioned_window": r"Window \[.*windowspecdefinition\((?:[^,]*ASC|[^,]*DESC)",
    "row_python_udf": r"BatchEvalPython",
}


def audit(spark, sf_dir):
    out = {}
    for name in sorted(QUERIES):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        hits = [k for k, p in PATTERNS.items() if re.search(p, plan)]
        out[name] = (hits, plan.count("FileScan"), plan.count("Exchange"))
    return out


if __name__ == "__main__":
    spark = get_spark()
    res = audit(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
    for name, (hits, scans, exch) in res.items():
        flag = ",".join(hits) if hits else "-"
        print(f"{name:28s} scans={scans:3d} exchanges={exch:3d} {flag}")
