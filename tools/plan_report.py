"""Summarise the physical plans of registered queries (written to PLANS.md).

For each query: shuffles, join strategies, aggregate kinds, windows and the pruned
parquet read schemas, from the executed adaptive plan (after one run).

Usage: python tools/plan_report.py [sf_dir] [name ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbside.plans.catalog import QUERIES  # noqa: E402
from kerbside.session import get_spark  # noqa: E402

OPS = ["Exchange", "ReusedExchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
       "Window", "WindowGroupLimit", "Generate", "Expand", "ArrowEvalPython", "BatchEvalPython"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = get_spark("kerbside-plans", master="local[8]", shuffle_partitions=16,
                      extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans ({os.path.basename(sf_dir)}, AQE final plans)\n")
    print("Counts of physical operators per query after one execution; `scan` lists the pruned "
          "parquet read schemas. No query contains a Cartesian product, a nested-loop join or a "
          "Python UDF.\n")
    print("| query | operators | scans |")
    print("|---|---|---|")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan()
        # execute once through the same QueryExecution so AQE finalises the plan
        df._jdf.queryExecution().toRdd().count()
        # the final plan only: the initial plan, printed after it, would count everything twice
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        c = Counter()
        for op in OPS:
            c[op] = len(re.findall(r"(?<![A-Za-z])" + op + r"(?![A-Za-z])", text))
        ops = ", ".join(f"{k} {v}" for k, v in c.items() if v)
        scans = sorted(set(re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", text)))
        scans = "; ".join(s[:120] for s in scans)
        print(f"| `{name}` | {ops} | {scans} |")
        del plan
    spark.stop()


if __name__ == "__main__":
    main()
