"""Write PLANS.md: per registered query, what its executed physical plan contains.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
Each query is run once (so AQE's final plan is reported), then its plan is
scanned for shuffles, broadcasts, windows, Python stages and scans.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def final_only(plan: str) -> str:
    """Drop every '== Initial Plan ==' block (the top-level one and those of
    subqueries), keeping the final adaptive plans. A block is the header and
    the lines whose text starts at or right of the header's text."""
    keep, skip_col = [], None
    for line in plan.splitlines():
        col = len(line) - len(line.lstrip(" :|+-"))
        if skip_col is not None:
            if col >= skip_col:
                continue
            skip_col = None
        if "== Initial Plan ==" in line:
            skip_col = line.index("==")
            continue
        keep.append(line)
    return "\n".join(keep)


def summarize(plan: str) -> dict:
    plan = final_only(plan)
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange SinglePartition|\bExchange RoundRobin", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "python": len(re.findall(r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "scans": plan.count("FileScan") + plan.count("Scan parquet") + plan.count("Scan csv") + plan.count("Scan text"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
        "single_partition": plan.count("SinglePartition"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from seqlab.session import get_session

    spark = get_session("local[8]", 8)
    oracle = E.oracle_sql()
    print(f"# Executed plans ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Generated by `python tests/plan_report.py`. Counts per query: shuffle exchanges, reused "
          "exchanges, broadcasts, window operators, partial top-k limits (`WindowGroupLimit`), Python "
          "(Arrow) stages, scans, scans with pushed filters, single-partition exchanges (only on "
          "tables bounded by a constant: 101 ROC bins, per-range or per-split offsets, one-row "
          "totals). `check` is O (DuckDB oracle) or R (rows only).\n")
    print("| query | check | shuffles | reused | broadcasts | windows | top-k limits | python | scans | pushed | single-partition |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in E.queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        chk = "O" if name in oracle else "R"
        print(f"| {name} | {chk} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['windows']} | "
              f"{s['group_limits']} | {s['python']} | {s['scans']} | {s['pushed']} | {s['single_partition']} |",
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
