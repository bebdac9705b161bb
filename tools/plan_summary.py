"""Write PLANS.md from Spark's event log: what each key really ran, jobs that it
started while it was being defined included.

Usage: python tools/plan_summary.py [sf_dir] [key-prefix ...]

Every key runs under its own job group into Spark's no-op sink, with the event
log in a scratch folder.  Operators are those of the last plan that the log holds
for each execution (the one that ran, after adaptive re-planning).
"""
import glob
import json
import os
import re
import sys
import tempfile
from collections import Counter, defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.registry import QUERIES, load_all  # noqa: E402
from strata.session import build_session  # noqa: E402

OPERATORS = {
    "broadcast joins": r"BroadcastHashJoin", "sort-merge joins": r"SortMergeJoin|ShuffledHashJoin",
    "nested loops": r"BroadcastNestedLoopJoin|CartesianProduct", "windows": r"^Window",
    "scans": r"^Scan parquet", "Python": r"Python|Arrow|Pandas",
}
FIGURES = ("jobs", "before", "shuffles", *OPERATORS, "rows read", "rows shuffled")


def nodes(plan: dict):
    yield plan
    for child in plan["children"]:
        yield from nodes(child)


def read(folder: str) -> dict[str, Counter]:
    """Figures by job group, from the event log."""
    out: dict[str, Counter] = defaultdict(Counter)
    plans, group_of_execution, group_of_stage = {}, {}, {}
    for path in glob.glob(f"{folder}/**/*", recursive=True):
        for line in open(path) if os.path.isfile(path) else ():
            e = json.loads(line)
            kind = e["Event"].rpartition(".")[2]
            if kind == "SparkListenerJobStart":
                p = e.get("Properties", {})
                group = p.get("spark.jobGroup.id")
                if group:
                    out[group]["jobs"] += 1
                    for s in e["Stage IDs"]:
                        group_of_stage.setdefault(s, group)
                    if "spark.sql.execution.id" in p:
                        group_of_execution[int(p["spark.sql.execution.id"])] = group
            elif "sparkPlanInfo" in e:
                plans[e["executionId"]] = e["sparkPlanInfo"]
            elif kind == "SparkListenerTaskEnd" and (group := group_of_stage.get(e["Stage ID"])):
                m = e.get("Task Metrics") or {}
                out[group]["rows read"] += m.get("Input Metrics", {}).get("Records Read", 0)
                out[group]["rows shuffled"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
    for execution, group in group_of_execution.items():
        for n in nodes(plans.get(execution, {"nodeName": "", "children": []})):
            name = n["nodeName"].strip()
            out[group]["shuffles"] += name == "Exchange"
            for label, pattern in OPERATORS.items():
                out[group][label] += bool(re.search(pattern, name))
    return out


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    log = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    load_all()
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    sc = spark.sparkContext
    keys = [k for k in sorted(QUERIES) if not args or any(k.startswith(a) for a in args)]
    for k in keys:
        sc.setJobGroup(f"define {k}", k)
        df = QUERIES[k](spark, sf)
        sc.setJobGroup(f"run {k}", k)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    found = read(log)
    lines = ["# PLANS", "",
             f"Generated by `tools/plan_summary.py` from Spark's event log on `{sf}` (keys in order in one session, so a",
             "stand-in dimension is counted with the first key that builds it).  *jobs* counts all jobs, *before* those",
             "started while the key was being defined (tables that are written once and read several times); operators are",
             "those of the plans that ran, written tables included.", "",
             "| key | " + " | ".join(FIGURES) + " |", "| --- |" + " --- |" * len(FIGURES)]
    loops = []
    for k in keys:
        before, ran = found[f"define {k}"], found[f"run {k}"]
        total = before + ran
        total["before"] = before["jobs"]
        loops += [k] * (total["nested loops"] > 0)
        lines.append(f"| `{k}` | " + " | ".join(f"{total[f]:,}" for f in FIGURES) + " |")
    lines += ["", f"{len(keys)} keys; keys that ran a nested-loop or cartesian join: {', '.join(loops) or 'none'}."]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print(lines[-1])


if __name__ == "__main__":
    main()
