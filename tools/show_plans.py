"""Summarise the executed (post-AQE) physical plan of registered queries as a markdown table.

    python tools/show_plans.py [sf_dir] [query ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pidlink.plans import jobs  # noqa: E402
from pidlink.plans import queries as Q  # noqa: E402
from pidlink.session import build_session  # noqa: E402

OPS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "hash agg": r"\bHashAggregate",
    "object agg": r"ObjectHashAggregate",
    "sort agg": r"SortAggregate",
    "window": r"\bWindow\b",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow|PythonUDF",
}


def summary(df) -> str:
    """Operator counts and scanned columns of the final plan, as table cells."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # execute this DataFrame's own plan so AQE finalises it
    plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]  # the final plan only
    counts = [str(len(re.findall(p, plan))) for p in OPS.values()]
    schemas = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
    cols = "; ".join(sorted({c.split(":")[0] for sch in schemas for c in sch.split(",") if c}))
    return " | ".join(counts) + f" | {cols}"


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or list(Q.QUERIES)
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Executed plans at `{sf}` (AQE final plans; counts of operators)\n")
    print("Generated by `tools/show_plans.py`. Scans list their pruned `ReadSchema` columns. "
          "What a query stores with a checkpoint before its own plan begins has a row of its own "
          "(stored input).\n")
    print("| query | " + " | ".join(OPS) + " | scanned columns |")
    print("| --- | " + " | ".join("---" for _ in OPS) + " | --- |")
    stored = []  # plans of what a query stores before its own plan begins
    cut = jobs.cut_lineage

    def recorded(df):
        stored.append(summary(df))
        return cut(df)

    jobs.cut_lineage = recorded
    for n in names:
        stored.clear()
        df = Q.QUERIES[n](spark, sf)
        for i, row in enumerate(stored, 1):
            print(f"| `{n}`, stored input {i} | {row} |")
        print(f"| `{n}` | {summary(df)} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
