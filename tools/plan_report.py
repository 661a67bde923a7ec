"""Physical-plan summary of every registered query (markdown table on stdout).

    python tools/plan_report.py [sf_dir]

Counts shuffles (hash / range / single-partition), broadcasts, windows and generators in
the plan Spark would run, and flags nested-loop or cartesian joins, sort-based aggregates and
Python evaluation.  ``pushed`` lists the filters handed to the Parquet scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronoweave.session import local_session  # noqa: E402
from chronoweave.workloads import QUERIES  # noqa: E402


def summarize(plan: str) -> dict:
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast": plan.count("BroadcastExchange"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "generate": len(re.findall(r"\bGenerate ", plan)),
        "flags": ",".join(x for x in ("BroadcastNestedLoopJoin", "CartesianProduct", "SortAggregate",
                                      "BatchEvalPython", "ArrowEvalPython") if x in plan) or "-",
        "pushed": sorted({x for x in (m.rstrip("]") for m in re.findall(r"PushedFilters: \[(.*?), ReadSchema", plan)) if x}),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("| query | hash shuffles | range | single-partition | broadcasts | windows | generators | flags | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        df = q(spark, sf)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        pushed = "; ".join(p if len(p) <= 90 else p[:87] + "..." for p in s["pushed"]) or "-"
        print(f"| {name} | {s['hash']} | {s['range']} | {s['single']} | {s['broadcast']} | {s['window']} | "
              f"{s['generate']} | {s['flags']} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
