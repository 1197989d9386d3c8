"""Benchmark the headline analyses; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built from scratch (so eager steps inside it count), then run
to completion into the ``noop`` sink. One warm-up pass, then the median of
``BENCH_RUNS`` timed passes per query. ``value`` is the sum of the medians.
Also reported per query: exchanges of all its jobs (stored frames, small ranking
jobs, the final job). Each analysis also runs with a seller state and with a date
range; their times are in ``queries`` and ``value`` sums the six headline
queries alone, to compare with earlier rounds (``value_all``: all of them).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.plans.jobs import plan_of, recorded, shape  # noqa: E402
from mercato.plans.registry import QUERIES  # noqa: E402
from mercato.session import local_session  # noqa: E402

HEADLINE = [
    "seller_scorecard",
    "abc_classification",
    "cohort_retention",
    "delivery_by_state",
    "monthly_growth",
    "check_summary",
]
FILTERED = [
    "seller_scorecard_by_state",
    "seller_scorecard_date_range",
    "abc_classification_by_state",
    "abc_classification_date_range",
    "cohort_retention_by_state",
    "cohort_retention_date_range",
    "delivery_in_seller_state",
    "delivery_date_range",
    "monthly_growth_by_state",
    "monthly_growth_date_range",
]


def _plan_stats(jobs, df) -> dict:
    shapes = [shape(p) for _, p in jobs] + [shape(plan_of(df))]
    return {"jobs": len(shapes)} | {k: sum(x[k] for x in shapes) for k in shapes[0]}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + FILTERED)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="bench")

    def once(name):
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0, df

    timings, plans, errors = {}, {}, {}
    for name in names:
        try:
            with recorded() as jobs:
                _, df = once(name)  # warm-up
            plans[name] = _plan_stats(jobs, df)
            timings[name] = round(statistics.median(once(name)[0] for _ in range(runs)), 3)
        except Exception as exc:  # noqa: BLE001 - report and go on with the other queries
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.get(q, 0) for q in HEADLINE), 3),
        "value_all": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "plans": plans,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
