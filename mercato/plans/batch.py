"""The batch run: checks, the five analyses, their outputs.

Mirrors the reference product's run: checks only warn, so they run beside the
analyses; each analysis is independent, so they run side by side, each in a scheduler
pool of its own (the small jobs of one fill the cores that another leaves
idle), and one failing analysis is logged while the others go on;
outputs are the top-50 seller summary (CSV), the full ABC table (parquet)
and the data behind each report chart and sheet (parquet), all written by
Spark's distributed writers into ``output_dir`` (any Hadoop-compatible
path).
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import abc, checks, cohort, delivery, monthly, scorecard
from mercato.operators.order_lines import order_lines
from mercato.operators.ranking import numbered
from mercato.params import NO_FILTER, Params
from mercato.session import ensure_checkpoint_dir, tune
from mercato.sources.sinks import write_csv, write_parquet

log = logging.getLogger("mercato")

SUMMARY_ROWS = 50  # fixed value: sellers in summary.csv

# The order each analysis is written in (the reference's ORDER BY, with a
# tie-break). A distributed sort: range-partitioned, then sorted per partition.
OUTPUT_ORDER = {  # column -> descending?
    "seller_scorecard": [("composite_score", True), ("seller_id", False)],
    "abc_classification": [("revenue", True), ("product_id", False)],
    "cohort_retention": [("cohort_month", False)],
    "delivery_by_state": [("avg_days_early", True), ("state", False)],
    "monthly_growth": [("month", False)],
}


def _output_order(name: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in OUTPUT_ORDER[name]]


def ordered_for_output(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(*_output_order(name))


def numbered_for_output(df: DataFrame, name: str) -> DataFrame:
    """``df`` with each row's ``position`` in the analysis' output order, from 1 on."""
    return numbered(df, *_output_order(name))


@dataclass
class RunResult:
    checks_passed: bool | None = None
    failed_checks: list[dict] = field(default_factory=list)
    written: dict[str, bool] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def _try(result: RunResult, name: str, fn):
    try:
        return fn()
    except Exception as exc:  # noqa: BLE001 - one failed analysis must not stop the run
        log.error("%s failed: %s", name, exc)
        result.errors[name] = f"{type(exc).__name__}: {exc}"
        return None


@contextmanager
def _side_by_side(spark: SparkSession, parallel: int) -> Iterator[Callable[[str, Callable[[], None]], None]]:
    """``start(name, job)`` runs ``job`` beside others, its Spark jobs in the scheduler pool ``name``; all have ended at the end.

    A pool is a fair share of the executors where the cluster's ``spark.scheduler.mode`` is FAIR; else the
    jobs queue, and later ones take the cores that earlier ones leave idle. The caller's job group and tags hold.
    """
    running: list[Future] = []
    with ThreadPoolExecutor(parallel, "mercato") as threads:

        def start(name: str, job: Callable[[], None]) -> None:
            def in_pool() -> None:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
                job()

            running.append(threads.submit(inheritable_thread_target(spark)(in_pool)))

        yield start
    for done in running:
        done.result()  # raises what a job did not handle


def _shared_lines(t, params: Params) -> DataFrame | None:
    """The stored :func:`~mercato.operators.order_lines.order_lines` that three analyses aggregate:
    the items are read and joined once per run. None if they can't be made: each analysis then
    joins its own, and those that lack a table or column fail on their own."""
    for reviews in (True, False):
        try:
            return order_lines(t, params, reviews=reviews)
        except Exception as exc:  # noqa: BLE001 - e.g. no review table
            log.warning("no shared lines (reviews: %s): %s", reviews, exc)
    return None


def run_batch(
    t,
    output_dir: str,
    params: Params = NO_FILTER,
    now: _dt.datetime | None = None,
    parallel: int = 4,
) -> RunResult:
    """Run checks, analyses and sinks, ``parallel`` of them at a time; return what passed, what was written, what failed."""
    if parallel < 1:
        raise ValueError(f"parallel={parallel}: at least one analysis runs at a time")
    result = RunResult()
    out = output_dir.rstrip("/")
    tune(t.spark)
    ensure_checkpoint_dir(t.spark)  # before threads meet

    def check() -> None:
        rows = _try(result, "checks", lambda: checks.run_checks(t, now))
        if rows is not None:
            result.failed_checks = [r for r in rows if not r["passed"]]
            result.checks_passed = not result.failed_checks
            for r in result.failed_checks:
                log.warning("check failed: %s", r)

    def save(name: str, fn) -> None:
        ok = _try(result, name, fn)
        result.written[name] = bool(ok)

    def parquet(build):
        return lambda df, target: write_parquet(build(df), target)

    def analysis(name: str, build, output: str, path: str, reports: dict) -> None:
        """Build and write an analysis, then its report tables from the written one: a lineage cut, no recompute."""
        df = _try(result, name, build)
        if df is None:
            return
        save(output, lambda: write_parquet(ordered_for_output(df, name), path))
        if not result.written[output]:
            result.written.update({report: False for report in reports})
            return
        written = t.spark.read.parquet(path)
        for report, (fn, target) in reports.items():
            save(report, lambda fn=fn, target=target: fn(written, target))

    rep = f"{out}/report"
    from_orders = [
        ("cohort_retention", lambda: cohort.cohort_retention(t, params), "cohort_retention", f"{rep}/cohort_retention",
         {"cohort_retention_long": (parquet(cohort.long_form), f"{rep}/cohort_retention_long")}),
        ("delivery_by_state", lambda: delivery.delivery_by_state(t, params), "delivery_by_state", f"{rep}/delivery_by_state",
         {"delivery_days_early": (parquet(delivery.days_early_of), f"{rep}/delivery_days_early")}),
    ]
    with _side_by_side(t.spark, parallel) as start:
        start("checks", check)
        for name, *rest in from_orders:
            start(name, lambda name=name, rest=rest: analysis(name, *rest))
        lines = _shared_lines(t, params)
        with_reviews = lines if lines is not None and "score_sum" in lines.columns else None
        from_lines = [
            ("seller_scorecard", lambda: scorecard.seller_scorecard(t, params, lines=with_reviews),
             "seller_scorecard", f"{rep}/seller_scorecard",
             {"summary.csv": (lambda df, p: write_csv(scorecard.top_sellers(df, SUMMARY_ROWS), p, True), f"{out}/summary.csv"),
              "top_sellers_10": (parquet(lambda df: scorecard.top_sellers(df, 10)), f"{rep}/top_sellers_10")}),
            ("abc_classification", lambda: abc.abc_classification(t, params, lines=lines),
             "detail.parquet", f"{out}/detail.parquet",
             {"abc_tier_summary": (parquet(abc.summarize_tiers), f"{rep}/abc_tier_summary")}),
            ("monthly_growth", lambda: monthly.monthly_growth(t, params, lines=lines),
             "monthly_growth", f"{rep}/monthly_growth",
             {"monthly_series": (parquet(lambda df: monthly.series_of(df).orderBy("month_label")), f"{rep}/monthly_series")}),
        ]
        for name, *rest in from_lines:
            start(name, lambda name=name, rest=rest: analysis(name, *rest))
    return result
