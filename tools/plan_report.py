"""Summarise the physical plan of every registered query as it would run at scale.

    python tools/plan_report.py [sf_dir] > PLANS.md

Broadcast joins are switched off (static and adaptive), which is what the
planner picks when every table is large. For each query: the shuffle
exchanges and their keys, single-partition exchanges, and the filters
pushed into the parquet scans, over all jobs it runs: frames it stores,
small ranking jobs, and the final job.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.plans.jobs import plan_of, recorded, shape  # noqa: E402
from mercato.plans.registry import QUERIES  # noqa: E402
from mercato.session import local_session  # noqa: E402


def _keys(text: str) -> str:
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"knownfloatingpointnormalized\(normalizenanandzero\((.*?)\)\)", r"\1", text)
    return text


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    print("# Physical plans at scale (broadcasts off)\n")
    print("Generated by `tools/plan_report.py`, over all jobs of a query: *stored* frames (checkpoints), *small* jobs")
    print("(ranking boundaries and bucket counts: partial aggregates, a few rows) and the *final* job.\n")
    print("| Query | Shuffles: stored + small + final | Shuffle keys | SinglePartition: stored + small + final | Pushed filters |")
    print("|---|---|---|---|---|")
    for name, q in QUERIES.items():
        with recorded() as jobs:
            df = q(spark, sf_dir)
        parts = [[p for k, p in jobs if k == "checkpoint"], [p for k, p in jobs if k == "collect"], [plan_of(df)]]
        total = lambda what: " + ".join(str(sum(shape(p)[what] for p in ps)) for ps in parts)
        text = "\n".join(p for ps in parts for p in ps)
        keys = "; ".join(sorted({_keys(k)[:60] for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)}))
        pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p and p != "IsNotNull(o_orderkey)"})
        pf = "; ".join(_keys(p)[:70] for p in pushed)[:160]
        print(f"| {name} | {total('exchanges')} | {keys} | {total('single_partition')} | {pf} |")
    spark.stop()


if __name__ == "__main__":
    main()
