"""Summarize the physical plan of every registered job (no execution).

Usage: python tools/plans.py [sf_dir] > PLANS.md
Per job: shuffles (hash/range/single-partition exchanges), broadcasts, join
strategies, windows, whether ledger scans carry partition filters, and the
columns read from the stored ledger.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def strip_cached(plan: str) -> str:
    """Drop the subtrees under InMemoryRelation (cached, computed once per session)."""
    out, skip = [], None
    for line in plan.splitlines():
        ind = len(line) - len(line.lstrip(" :|+-"))
        if skip is not None and ind > skip:
            continue
        skip = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip = ind
    return "\n".join(out)


def summarize(plan: str) -> dict:
    plan = strip_cached(plan)
    ledger_scans = [b for b in plan.split("FileScan parquet")[1:] if "ledgerloom/ledger-" in b]
    schemas = set()
    pruned = 0
    for b in ledger_scans:
        m = re.search(r"ReadSchema: struct<([^\n]*)", b)
        if m:
            body = m.group(1)
            truncated = not body.rstrip().endswith(">")
            fields = re.split(r",(?![^(]*\))", body.rstrip().rstrip(">"))
            names = [f.split(":")[0].strip() for f in fields if ":" in f]
            schemas.add(" ".join(names) + (" ..." if truncated else ""))
        pf = re.search(r"PartitionFilters: \[([^\n]*)\]", b)
        if pf and re.search(r"scenario_id#\d+ (=|IN)|year#\d+ (=|IN|<|>)", pf.group(1)):
            pruned += 1
    return {
        "shuffle": len(re.findall(r"Exchange hashpartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": len(re.findall(r"BroadcastExchange", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bnlj": len(re.findall(r"BroadcastNestedLoopJoin", plan)),
        "window": len(re.findall(r"\bWindow\b", plan)),
        "cached": len(re.findall(r"InMemoryRelation", plan)),
        "ledger_scans": len(ledger_scans),
        "pruned": pruned,
        "cols": "; ".join(sorted(schemas)) or "-",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ledgerloom.plans import all_jobs
    from ledgerloom.session import build_session

    spark = build_session("local[4]", 8, app="ledgerloom-plans")
    print("# Physical plans of the registered jobs\n")
    print(f"Initial adaptive plans at `{sf_dir}` (AQE may still turn a shuffle join into a broadcast "
          "join or coalesce partitions at runtime). Shuffle = hash exchange; single = exchange to one "
          "partition (only ever over pre-aggregated or bounded rows); pruned = ledger scans with "
          "partition filters on scenario or year.\n")
    print("| job | shuffle | single | broadcast | BHJ | SMJ | BNLJ | window | cached reads | ledger scans (pruned) "
          "| ledger columns read |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key, j in all_jobs().items():
        df = j.build(spark, sf_dir)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {key} | {s['shuffle']} | {s['single']} | {s['bcast']} | {s['bhj']} | {s['smj']} | "
              f"{s['bnlj']} | {s['window']} | {s['cached']} | {s['ledger_scans']} ({s['pruned']}) | {s['cols']} |")
    spark.stop()


if __name__ == "__main__":
    main()
