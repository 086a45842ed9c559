"""Print the formatted physical plan of registered queries.

Usage: ``python -m panelkit.plans.explain [sf_dir] name [name ...]``
(``--summary`` prints one line per query: exchanges, sorts, windows,
broadcasts, pushed filters.)
"""

from __future__ import annotations

import re
import sys


def plan_summary(df) -> dict:
    """Operator counts of the physical plan (node lines of the plan tree)."""
    p = df._jdf.queryExecution().executedPlan().toString()
    nodes = [re.sub(r"^[\s:+\-|]*", "", line) for line in p.splitlines()]

    def count(prefix: str) -> int:
        return sum(1 for n in nodes if n.startswith(prefix))
    return {
        "scans": count("FileScan"),
        "shuffles": sum(1 for n in nodes if n.startswith("Exchange ") and "SinglePartition" not in n),
        "single_partition_exchanges": sum(1 for n in nodes if n.startswith("Exchange SinglePartition")),
        "broadcasts": count("BroadcastExchange"),
        "sorts": count("Sort "),
        "windows": count("Window "),
        "window_group_limits": count("WindowGroupLimit"),
        "cross_joins": count("CartesianProduct") + count("BroadcastNestedLoopJoin"),
    }


def main(argv: list[str]) -> int:
    from panelkit.config import local_session
    from panelkit.plans.catalog import all_queries
    summary = "--summary" in argv
    argv = [a for a in argv if a != "--summary"]
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")] or list(all_queries())
    spark = local_session()
    reg = all_queries()
    for n in names:
        df = reg[n].fn(spark, sf_dir)
        if summary:
            print("SUMMARY", n, plan_summary(df), flush=True)
        else:
            print(f"== {n} ==")
            df.explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
