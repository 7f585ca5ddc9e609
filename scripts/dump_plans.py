"""Write the executed physical plan of every registered query to docs/PLANS.md.

    python scripts/dump_plans.py [sf_dir]

For small data: each query's rows are collected once, so the plan
shown is AQE's final plan: the join strategies chosen at runtime, reused
exchanges, and the pruned read schema of every scan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dockwise.plans import catalog  # noqa: E402
from dockwise.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # run this DataFrame's own plan so AQE finalises it (small at sf0.01)
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)  # expression ids only add noise
    text = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*\]", "Location: lineitem.parquet", text)
    return text.rstrip()


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Executed plans\n",
        f"Final (post-AQE) physical plans of every registered query on `{sf_dir}`, "
        "written by `scripts/dump_plans.py`. Expression ids are removed.\n",
    ]
    for name, q in catalog.REGISTRY.items():
        df = q.build(spark, sf_dir)
        out.append(f"\n## {name} ({q.survey})\n\n```\n{final_plan(df)}\n```\n")
    path = os.path.join(ROOT, "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
