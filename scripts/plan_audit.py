"""Summarise the physical plan of every registered query into PLANS.md:
shuffles, broadcasts, windows, Python stages, scans and the columns they
read. Plans are taken from ``explain`` only (nothing is executed), except
for queries whose construction itself runs jobs (fits, streams, checkpoints).

usage: python scripts/plan_audit.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    ops = [l.strip() for l in lines]

    def count(pattern: str) -> int:
        return sum(1 for l in ops if re.search(pattern, l))

    schemas = sorted(set(re.findall(r"ReadSchema: (struct<\S*>)", plan)))
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin"),
        "broadcasts": count(r"BroadcastExchange"),
        "joins": count(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"),
        "nested_loop": count(r"BroadcastNestedLoopJoin|CartesianProduct"),
        "windows": count(r"^[+\-: ]*Window "),
        "python": count(r"MapInPandas|FlatMapGroupsInPandas|FlatMapCoGroupsInPandas|ArrowEvalPython|BatchEvalPython"),
        "scans": schemas,
    }


def main() -> None:
    from tabula.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tabula import registry

    spark = local_session(8)
    oracle = registry.ORACLE
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_audit.py` on `{sf_dir}` (Spark {spark.version}, AQE on; the counts are of the")
    print("initial plan: AQE may still turn a sort-merge join into a broadcast join by measured size).\n")
    print("| Query | Oracle | Shuffles | Broadcasts | Joins | Nested-loop joins | Windows | Python stages | Scan columns |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in registry.QUERIES.items():
        try:
            df = fn(spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
            s = summarise(plan)
            cols = "; ".join(sc[len("struct<"):-1] for sc in s["scans"]) or "(derived input)"
            print(f"| {name} | {'Y' if name in oracle else 'rows'} | {s['shuffles']} | {s['broadcasts']} | "
                  f"{s['joins']} | {s['nested_loop']} | {s['windows']} | {s['python']} | {cols} |")
        except Exception as exc:  # report, keep going
            print(f"| {name} | error: {str(exc)[:80]} | | | | | | | |")
    spark.stop()


if __name__ == "__main__":
    main()
