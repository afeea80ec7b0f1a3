"""Write PLANS.md: the executed physical plan shape of every registered query.

python -m tests.plan_report [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import re
import sys


def summarize(plan: str) -> dict[str, str]:
    def n(pat):
        return len(re.findall(pat, plan))

    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    kinds = {}
    for e in exchanges:
        kinds[e] = kinds.get(e, 0) + 1
    scans = re.findall(r"FileScan \w+ [^\n]*", plan)
    pushed = sum(1 for ln in scans if re.search(r"PushedFilters: \[[^\]]", ln))
    return {
        "exchanges": ", ".join(f"{k} x{v}" for k, v in sorted(kinds.items())) or "none",
        "joins": ", ".join(
            f"{j} x{n(j)}" for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct") if n(j)
        )
        or "none",
        "aggregates": ", ".join(f"{a} x{n(a + r'\(')}" for a in ("HashAggregate", "ObjectHashAggregate", "SortAggregate") if n(a + r"\("))
        or "none",
        "windows": str(n(r"\bWindow \[")),
        "scans (with pushed filters)": f"{len(scans)} ({pushed})",
        "partition filters": "yes" if re.search(r"PartitionFilters: \[[^\]]+\]", plan) else "",
        "subqueries": str(n(r"Subquery ")),
        "top-k": "yes" if "TakeOrderedAndProject" in plan else "",
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tillroll.registry import QUERIES
    from tillroll.session import local_session

    spark = local_session(8)
    rows = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarize(plan)))
    cols = list(rows[0][1])
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Executed (AQE final) plans at `{sf}` on local[8], produced by `python -m tests.plan_report`.",
        "Registry queries over the fact read the written Parquet fact; the cleaning-step queries",
        "read the written raw table. Small lookups and deduplicated rows that are read twice are",
        "written tables and appear as scans.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "|---|" + "---|" * len(cols),
    ]
    out += [f"| `{name}` | " + " | ".join(s[c] for c in cols) + " |" for name, s in rows]
    open("PLANS.md", "w").write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
