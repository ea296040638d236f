"""Run every registered query on a data folder and summarise its executed
(adaptive, final) physical plan as a markdown table:
python tools/plan_summary.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "scans": r"Scan parquet|FileScan|Scan csv|Scan ExistingRDD|InMemoryTableScan",
    "exchanges": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"^\s*[:+\- ]*Window \[",
    "python": r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython",
    "single_partition": r"SinglePartition",
}


def summarise(plan: str) -> dict:
    out = {k: len(re.findall(p, plan, flags=re.M)) for k, p in PATTERNS.items()}
    out["pushed"] = "yes" if re.search(r"PushedFilters: \[[^\]]+\]", plan) else "-"
    return out


def executed(fn, spark, sf_dir) -> tuple[dict, int]:
    """Shape of the executed plan, and tables written while it was built."""
    from stockyard.session import scratch_count
    before = scratch_count()
    df = fn(spark, sf_dir)
    wrote = scratch_count() - before
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return summarise(plan), wrote


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from stockyard.plans.registry_io import QUERIES as qs
    from stockyard.session import build_session
    spark = build_session("local[8]", 16)
    print(f"# Executed plans at `{sf_dir}`\n")
    print("Final adaptive plans (after AQE re-planning) of every registered query of the library, "
          "local[8], 16 shuffle partitions. The tables are small here, so joins are broadcast by "
          "their measured size; the columns named `large` come from a run with broadcasts switched "
          "off, as for tables beyond the threshold. Counts are operator occurrences; `bnlj` counts "
          "nested-loop / cartesian joins, `single` exchanges to one partition (only the last step "
          "of a global aggregate), `tables` those written before the query itself runs (their "
          "plans are those of the queries they hold). Generated by `tools/plan_summary.py`.\n")
    cols = ["scans", "exchanges", "bhj", "smj", "bnlj", "windows", "python", "single_partition", "pushed"]
    head = [c.replace("single_partition", "single") for c in cols]
    print("| query | " + " | ".join(head) + " | large: exchanges | large: smj | tables |")
    print("| --- | " + " | ".join("---" for _ in range(len(cols) + 3)) + " |")
    key = "spark.sql.autoBroadcastJoinThreshold"
    small = spark.conf.get(key)
    for name in sorted(qs):
        a, wrote = executed(qs[name], spark, sf_dir)
        spark.conf.set(key, "-1")
        b, _ = executed(qs[name], spark, sf_dir)
        spark.conf.set(key, small)
        print(f"| {name} | " + " | ".join(str(a[c]) for c in cols)
              + f" | {b['exchanges']} | {b['smj']} | {wrote} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
