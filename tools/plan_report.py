"""Summarise the physical plan of every registered query (static plan, before AQE).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from repsmith.plans.catalog import QUERIES  # noqa: E402
from repsmith.session import get_session  # noqa: E402

NODES = ["Exchange", "BroadcastExchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate", "SortAggregate",
         "ObjectHashAggregate", "Generate", "ArrowEvalPython", "BatchEvalPython", "Scan parquet", "Subquery"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    print("# Physical plans of the registered queries\n")
    print(f"Static plans (`explain(\"formatted\")`, before AQE re-planning) at `{sf_dir}`. Counts are plan nodes; "
          "`pushed` lists the scans that carry pushed filters beyond not-null checks.\n")
    print("| query | exch | bcast | SMJ | SHJ | BHJ | BNLJ | cart | window | agg | scans | py-udf | pushed |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        heads = re.findall(r"^\(\d+\) ([A-Za-z ]+?)\s*$", text, flags=re.M)
        c = Counter(h.strip() for h in heads)
        pushed = []
        for m in re.finditer(r"Location: InMemoryFileIndex \[file:[^\]]*/(\w+)\.parquet\]\nPushedFilters: \[(.*)\]", text):
            filt = [f for f in re.split(r", (?=[A-Z])", m.group(2)) if f and not f.startswith("IsNotNull")]
            if filt:
                pushed.append(f"{m.group(1)}: {'; '.join(filt)[:60]}")
        agg = c["HashAggregate"] + c["SortAggregate"] + c["ObjectHashAggregate"]
        print(f"| {name} | {c['Exchange']} | {c['BroadcastExchange']} | {c['SortMergeJoin']} | {c['ShuffledHashJoin']} | "
              f"{c['BroadcastHashJoin']} | {c['BroadcastNestedLoopJoin']} | {c['CartesianProduct']} | {c['Window']} | {agg} | "
              f"{c['Scan parquet']} | {c['ArrowEvalPython'] + c['BatchEvalPython']} | {'<br>'.join(sorted(set(pushed)))} |")


if __name__ == "__main__":
    main()
