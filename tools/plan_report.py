"""Summarise the executed (adaptive) physical plan of every registered query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Lists, per query, the shuffles, joins (strategy and type), aggregates
(partial/final), windows and scans with their read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martflow.session import build_session  # noqa: E402
from martflow.plans.queries import QUERIES  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window |Scan parquet|FileScan|InMemoryRelation|Generate")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Executed plans of the registered queries\n")
    print(f"Input `{sf}`, `local[8]`, AQE on, plain scans. Generated by `tools/plan_report.py`; one "
          "line per shuffle, join, aggregate, window and scan of the final adaptive plan.  The trade "
          "queries read the change-log table that `trade.land_changes` has written (its parse is a job "
          "of its own, before the plan below).\n")
    for k, fn in QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = []
        for ln in plan.splitlines():
            if not KEEP.search(ln):
                continue
            ln = re.sub(r"#\d+L?", "", ln)
            ln = re.sub(r"\[plan_id=\d+\]", "", ln)
            ln = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\],?", "", ln)
            lines.append(ln.rstrip()[:230])
        n_ex = sum("Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x for x in lines)
        n_bc = sum("BroadcastExchange" in x for x in lines)
        print(f"## {k}\n\nhash shuffles: {n_ex}, broadcasts: {n_bc}\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
