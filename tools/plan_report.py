"""Physical-plan summary of every registered query (writes PLANS.md).

For each query: shuffles (Exchange), join strategies, aggregate kinds,
windows, and whether filters reach the parquet scan. Plans are the final
adaptive plans after one run through the ``noop`` sink.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    # a run's plan holds the final one, then the first: the final one counts
    final = next((i for i, x in enumerate(lines) if "== Initial Plan ==" in x), len(lines))
    body = "\n".join(lines[:final])
    filters = re.findall(r"PushedFilters: \[(.*?)\](?:,|$)", body, re.M)
    ranges = [f for f in filters if re.search(r"EqualTo|LessThan|GreaterThan|\bIn\(|StringStartsWith", f)]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)[^\n]*?\b(LeftSemi|LeftAnti|LeftOuter|Inner|FullOuter|"
                       r"RightOuter|ExistenceJoin)\b", body)
    return {
        "exchanges": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                    r"\bExchange SinglePartition|\bExchange RoundRobin", body)),
        "broadcasts": body.count("BroadcastExchange"),
        "joins": ", ".join(f"{j}{(' ' + t) if t else ''}" for j, t in joins) or "-",
        "aggregates": ", ".join(sorted({a for a in re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)", body)})) or "-",
        "windows": len(re.findall(r"\bWindow \[", body)) or body.count("+- Window"),
        "pushed": "yes" if ranges else "-",
        "partition_filters": "yes" if re.search(r"PartitionFilters: \[[^\]]", body) else "-",
    }


def main() -> None:
    from tidemark.session import local_session
    from tidemark.plans import catalog

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, local)\n")
    print("Final adaptive plans, printed from the execution that ran. `exchanges` counts shuffles; "
          "`pushed` says whether an equality or range filter reached a parquet scan. Generated by "
          "`tools/plan_report.py`.\n")
    print("| query | exchanges | broadcasts | joins | aggregates | windows | pushed |")
    print("|---|---|---|---|---|---|---|")
    for name, query in catalog.QUERIES.items():
        df = query(spark, sf_dir)
        execution = df._jdf.queryExecution()
        execution.toRdd().count()  # runs this very plan, adaptive steps included
        plan = execution.executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {s['joins']} | "
              f"{s['aggregates']} | {s['windows']} | {s['pushed']} |")


if __name__ == "__main__":
    main()
