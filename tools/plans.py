"""Write the final physical plans of selected queries to PLANS.md.

Usage: python tools/plans.py [sf_dir] [query ...]
Each query is run once and the plan is read from that run, so the adaptive
plan is final; it is condensed to its operators, join strategies, scans (columns read and
filters pushed) and exchanges.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DEFAULT = ["count_to_mass", "road_inventory", "bus_inventory", "points_in_polygons", "industry_overlay_area", "total_inventory",
           "residential_inventory", "merge_region_into_field", "model_skill", "run_report", "category_share", "latest_reading",
           "site_overlay_area", "residential_from_sheets"]

KEEP = ("Exchange", "Join", "Scan", "Aggregate", "Window", "Generate", "Filter", "Union",
        "ArrowEvalPython", "BroadcastExchange", "Sort ", "TakeOrdered", "AQEShuffleRead")


def condense(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            m = re.search(r"^(.*?)FileScan parquet \[([^\]]*)\].*?PushedFilters: (\[[^\]]*\])", line)
            if m:
                line = f"{m.group(1)}FileScan parquet cols=[{m.group(2)}] PushedFilters={m.group(3)}"
        out.append(line[:230])
    return "\n".join(out)


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or DEFAULT
    from cellflux.catalog import queries
    from cellflux.session import local_session

    spark = local_session(shuffle_partitions=16)
    qs = queries()
    parts = [
        "# Final physical plans\n",
        f"Generated by `tools/plans.py` at `{sf_dir}` on local[*] with AQE on. Each plan is read "
        "from the run itself (`isFinalPlan=true`), condensed to scans "
        "(columns read, filters pushed), joins, aggregates (partial/final), windows, generators "
        "and exchanges.\n",
    ]
    for name in names:
        df = qs[name](spark, sf_dir)
        # run the frame's own execution, so that its plan is the final one
        run = df._jdf.queryExecution()
        run.toRdd().count()
        plan = run.executedPlan().toString()
        if "AdaptiveSparkPlan" in plan and "isFinalPlan=true" not in plan:
            raise RuntimeError(f"{name}: the plan is not final")
        plan = plan.split("== Initial Plan ==")[0]
        parts.append(f"## {name}\n\n```\n{condense(plan)}\n```\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv)
