"""The plans of all jobs a query or a run starts: stored frames, small ranking jobs, written outputs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

EXCHANGE = re.compile(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")


METADATA = "spark.sql.maxMetadataStringLength"  # a scan's filters are cut to it


def plan_of(df: DataFrame) -> str:
    """The physical plan, with the filters of its scans in full."""
    conf = df.sparkSession.conf
    was = conf.get(METADATA, None)
    conf.set(METADATA, "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        conf.unset(METADATA) if was is None else conf.set(METADATA, was)


@contextmanager
def recorded() -> Iterator[list[tuple[str, str]]]:
    """Within it, each ``checkpoint``, ``collect`` and ``write`` adds (its name, its physical plan)."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    jobs: list[tuple[str, str]] = []
    real = {name: getattr(Classic, name) for name in ("checkpoint", "collect")}
    write = Classic.write

    def noting(name):
        def run(self, *args, **kw):
            jobs.append((name, plan_of(self)))
            return real[name](self, *args, **kw)

        return run

    def writing(self):
        jobs.append(("write", plan_of(self)))
        return write.fget(self)

    try:
        for name in real:
            setattr(Classic, name, noting(name))
        Classic.write = property(writing)
        yield jobs
    finally:
        for name, f in real.items():
            setattr(Classic, name, f)
        Classic.write = write


def shape(plan: str) -> dict[str, int]:
    kinds = EXCHANGE.findall(plan)
    return {"exchanges": len(kinds), "single_partition": kinds.count("SinglePartition"), "broadcasts": plan.count("BroadcastExchange")}
