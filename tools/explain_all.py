"""Print the physical plan of every registered query and a count of the
operators worth a look (joins by strategy, exchanges, window limits,
sort aggregates, Python evaluation, cartesian products).

    python tools/explain_all.py [sf_dir] [out_file]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WATCH = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Exchange", "WindowGroupLimit",
         "SortAggregate", "HashAggregate", "Generate")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else None
    from runlens.plans.registry import QUERIES
    from runlens.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=16, conf={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    out = open(out_file, "w") if out_file else None
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {w: len(re.findall(rf"\b{w}\b", plan)) for w in WATCH}
        print(f"{name:22s} " + " ".join(f"{k}={v}" for k, v in counts.items() if v), flush=True)
        if out:
            out.write(f"===== {name}\n{plan}\n")
    if out:
        out.close()
    spark.stop()


if __name__ == "__main__":
    main()
