"""Print, per registered query, the plan operators that matter at scale:
nested-loop/cartesian joins, single-partition exchanges, windows (with their
partition keys), broadcasts, and scans with their read schema width."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402

FLAGS = ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "Window [", "BroadcastExchange",
         "WindowGroupLimit")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    from strata.plans.registry import QUERIES, load_all
    load_all()
    spark = build_session("local[8]", shuffle_partitions=8)
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        hits = []
        for ln in plan.splitlines():
            s = ln.strip()
            if any(f in s for f in FLAGS):
                hits.append(re.sub(r"#\d+L?", "", s)[:160])
        print(f"== {name}: exchanges={plan.count('Exchange ')} sorts={plan.count('Sort [')}")
        for h in hits:
            print("   ", h)
    spark.stop()


if __name__ == "__main__":
    main()
