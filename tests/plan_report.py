"""Write PLANS.md: the physical plan shape of every registered query.

Usage: python tests/plan_report.py [sf_dir]
Counts come from the executed (adaptive, final) plan after running the query with
the noop sink, so broadcast/sort-merge choices are the ones AQE made at runtime.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from graphweave.session import local_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "nested/cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash agg": r"\bHashAggregate",
    "sort agg": r"SortAggregate",
    "object agg": r"ObjectHashAggregate",
    "window": r"\bWindow\b",
    "python": r"MapInPandas|FlatMapCoGroupsInPandas|ArrowEvalPython|FlatMapGroupsInPandas",
    "single-partition": r"SinglePartition",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8, app="graphweave-plans")
    rows = []
    only = set(sys.argv[2:])
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # adaptive plans print both; keep the final one
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        pushed = sorted(set(x for x in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if x))
        rows.append((name, counts, schemas, pushed))
    out = ["# PLANS", "", f"Executed (final adaptive) plan shape of every registered query at `{sf}`,",
           "generated by `python tests/plan_report.py`. Columns count operators in the plan;",
           "`ReadSchema` lists the pruned scan schemas. `single-partition` appears only where a",
           "global aggregate's final step combines one partial row per partition (counts, stats).",
           "Queries that write files first (scripts, stores, stream output) show the plan of their",
           "final read-back; their writes are separate jobs.", "",
           "| query | " + " | ".join(PATTERNS) + " | scans (ReadSchema) |",
           "|---" * (len(PATTERNS) + 2) + "|"]
    for name, c, schemas, _pushed in rows:
        sc = "<br>".join(s.replace("|", "/") for s in schemas[:6]) + (" …" if len(schemas) > 6 else "")
        out.append(f"| {name} | " + " | ".join(str(c[k]) for k in PATTERNS) + f" | {sc} |")
    out.append("")
    pushed_rows = [(n, p) for n, _c, _s, p in rows if p]
    if pushed_rows:
        out += ["## Pushed filters", ""]
        for n, p in pushed_rows:
            out.append(f"* `{n}`: " + "; ".join(f"`{x}`" for x in p[:4]))
    target = "PLANS.md" if not only else "/tmp/PLANS.partial.md"
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), target), "w") as f:
        f.write("\n".join(out) + "\n")
    print("wrote PLANS.md", len(rows))


if __name__ == "__main__":
    main()
