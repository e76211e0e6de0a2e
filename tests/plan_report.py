"""Write PLANS.md: the final (adaptive) physical plan features of every registered query.

    python tests/plan_report.py [/root/testdata/sf0.1] [--no-broadcast]

``--no-broadcast`` turns both broadcast thresholds off and writes PLANS_SHUFFLE.md.

Each query's own plan is executed once (rows are counted on the executors, none is collected) so
that AQE's final plan (run-time broadcast conversions, coalesced partitions) is what gets reported.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def features(plan: str) -> dict:
    tree, _, details = plan.partition("\n\n")
    head = tree.split("+- == Initial Plan ==")[0]
    final = details
    return {
        "shuffles": len(re.findall(r"\bExchange \(\d+\)", head)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(\d+\)", head)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct) ?(\w+)?", head))),
        "aggregates": sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate) \(", head))),
        "windows": len(re.findall(r"\bWindow \(\d+\)", head)),
        "codegen_stages": len(re.findall(r"WholeStageCodegen|\* \w+ \(\d+\)", head)),
        "pushed": sorted(set(p for p in re.findall(r"PushedFilters: \[(.*?)\]", final) if p)),
        "partition_filters": sorted(set(p for p in re.findall(r"PartitionFilters: \[(.*?)\]", final) if p)),
        "read_schema": sorted(set(re.findall(r"ReadSchema: (struct<.*?>)", final))),
    }


def main(sf_dir: str, no_broadcast: bool = False) -> None:
    from ferry.plans.queries import QUERIES
    from ferry.session import build_session
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", 8, extra=off if no_broadcast else None)
    lines = ["# Physical plans of the registered queries", "",
             f"Final adaptive plans at `{sf_dir}` (local[8], 8 shuffle partitions), produced by "
             "`tests/plan_report.py`. Shuffles counts `Exchange` nodes of the final plan (a reused "
             "exchange counts once per use); joins list the strategy AQE settled on"
             + (", with both broadcast thresholds off: the shape for inputs too large to broadcast." if no_broadcast
                else " at this scale."), ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this plan (no rows to the driver) so AQE reports its final form
        plan = spark._jvm.PythonSQLUtils.explainString(qe, "formatted")
        f = features(plan)
        joins = ", ".join(f"{j} {k}".strip() for j, k in f["joins"]) or "—"
        lines.append(f"## `{name}`")
        lines.append("")
        lines.append(f"- shuffles: {f['shuffles']}, broadcasts: {f['broadcasts']}, windows: {f['windows']}, "
                     f"aggregates: {', '.join(f['aggregates']) or '—'}")
        lines.append(f"- joins: {joins}")
        for p in f["pushed"]:
            lines.append(f"- pushed filters: `{p}`")
        for p in f["partition_filters"]:
            lines.append(f"- partition filters: `{p}`")
        for r in f["read_schema"]:
            lines.append(f"- read schema: `{r}`")
        lines.append("")
        print(name, f["shuffles"], joins, flush=True)
    with open(os.path.join(ROOT, "PLANS_SHUFFLE.md" if no_broadcast else "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "--no-broadcast"]
    main(args[0] if args else "/root/testdata/sf0.1", "--no-broadcast" in sys.argv)
