"""Summarise the physical plans of the registered queries.

usage: python scripts/plan_report.py [sf_dir] [name ...] > PLANS.md

Plans are taken with AQE off and size-based broadcast off, as they would
look for inputs too large to broadcast (an explicit, size-checked
``broadcast_if_small`` still shows). Queries that write tables while being
built are skipped.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WRITES = {"write_replace", "write_partitioned", "dedup_by_merge", "snapshot_history", "time_travel_read",
          "rollback_to", "evolve_schema", "quarantine_write", "upsert_partitions", "read_table",
          "medallion_run", "medallion_incremental", "incremental_loads", "scan_json_files", "scan_csv_files",
          "fail_fast", "stream_session_window", "stream_ingest", "stream_to_parquet_by_date", "stream_corrupt_split",
          "stream_dedup", "stream_session_agg", "stream_upsert_gold", "stream_read"}

PATTERNS = {
    "hash exchanges": r"(?<!Reused)Exchange hashpartitioning",
    "reused exchanges": r"ReusedExchange",
    "single-partition exchanges": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "nested-loop / cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash aggregates": r"(?<!Object)HashAggregate",
    "object hash aggregates": r"ObjectHashAggregate",
    "sort aggregates": r"SortAggregate",
    "windows": r"\bWindow \[",
    "partial group limits": r"WindowGroupLimit .*Partial",
    "python eval": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def summarize(plan: str) -> dict:
    out = {}
    for k, p in PATTERNS.items():
        lines = [ln for ln in plan.splitlines() if re.search(p, ln)]
        if k != "reused exchanges":
            lines = [ln for ln in lines if "ReusedExchange" not in ln]
        out[k] = len(lines)
    scans = []
    for line in plan.splitlines():
        if "FileScan" in line:
            m_loc = re.search(r"\[file:[^\]]*/([a-z_]+)\.parquet\]", line)
            m_push = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            m_schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
            cols = len(re.findall(r"[a-z_0-9]+:", m_schema.group(1))) if m_schema else 0
            scans.append(f"{m_loc.group(1) if m_loc else '?'}({cols} cols"
                         + (f"; pushed {m_push.group(1)[:80]}" if m_push and m_push.group(1) else "") + ")")
    out["scans"] = "; ".join(sorted(Counter(scans)))
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from strata.session import get_session
    spark = get_session("local[4]", shuffle_partitions=200)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    from strata.queries import QUERIES
    print("# Physical plan summary\n")
    print("AQE off, size-based broadcast off (plans as for inputs too large to broadcast); "
          "explicit size-checked broadcasts of small dimensions remain. Generated by "
          "`scripts/plan_report.py`.\n")
    cols = list(PATTERNS)
    print("| query | " + " | ".join(cols) + " | scans (columns read; pushed filters) |")
    print("|---|" + "---|" * (len(cols) + 1))
    for name in names or sorted(QUERIES):
        if name in WRITES:
            continue
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + f" | {s['scans']} |")
    spark.stop()


if __name__ == "__main__":
    main()
