"""Summarise the final physical plan of every registered query (PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query runs once (so adaptive plans are final); the table counts the
operators that matter at scale: shuffles by kind, broadcasts, group-limited
windows, distributed top-k, subqueries and what the events scan reads.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SPREAD = r"Exchange (?:RoundRobinPartitioning|hashpartitioning\(event_id#\d+L, ts)"
KINDS = [
    ("hash shuffles", r"Exchange hashpartitioning(?!\(event_id#\d+L, ts)"),
    ("source spread", SPREAD),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("WindowGroupLimit", r"WindowGroupLimit"),
    ("TakeOrdered", r"TakeOrderedAndProject"),
    ("Window", r"\bWindow \["),
    ("subqueries", r"Subquery subquery"),
    ("joins", r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"),
]


def main() -> None:
    from pulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    from pulse.plans.catalog import QUERIES

    print(f"# Physical plans of the registered queries ({Path(sf).name})\n")
    print("Final adaptive plans after one run (`tools/plan_report.py`). Counts include "
          "subquery plans; `events scan` is the columns read from the events table.\n")
    print("| query | " + " | ".join(k for k, _ in KINDS) + " | events scan |")
    print("| --- " * (len(KINDS) + 2) + "|")
    for name, q in QUERIES.items():
        df = q(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(rx, plan))) for _, rx in KINDS]
        m = re.search(r"events\.parquet.*?ReadSchema: (struct<[^>]*>)", plan, re.S)
        cols = m.group(1).replace("struct<", "").replace(">", "") if m else "(materialised input)"
        cols = ", ".join(c.split(":")[0] for c in cols.split(","))
        print(f"| {name} | " + " | ".join(counts) + f" | {cols} |")


if __name__ == "__main__":
    main()
