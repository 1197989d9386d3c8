"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the driver's test tables through the test mapping
(:meth:`Tables.from_tpch`) and runs one operator over all of it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions import cents_to_double
from mercato.operators import abc, checks, cohort, delivery, filters, monthly, scorecard
from mercato.params import NO_FILTER, Params
from mercato.plans.batch import OUTPUT_ORDER, numbered_for_output
from mercato.plans.settings import END, NOW, START, STATE
from mercato.session import tune
from mercato.sources.tables import Tables

BY_STATE = Params(seller_state=STATE)
DATE_RANGE = Params(start_date=START, end_date=END)
FIXED_NOW = _dt.datetime.strptime(NOW, "%Y-%m-%d %H:%M:%S")


_TABLES: dict[tuple[int, str], Tables] = {}


def mapped_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The mapped test tables, built once per session and folder (lazy frames)."""
    key = (id(spark), sf_dir)
    if key not in _TABLES or _TABLES[key].spark is not spark:
        _TABLES[key] = Tables.from_tpch(spark, sf_dir)
    return _TABLES[key]


def _query(fn, params: Params = NO_FILTER, **options) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(mapped_tables(spark, sf_dir), params, **options)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _orders_date_range(t, p):
    return filters.in_date_range(t["orders"], p)


def _orders_by_seller_state(t, p):
    return filters.orders_with_seller_in(t["orders"], t["order_items"], t["sellers"], p.state)


def _seller_percent_ranks(t, p):
    r = scorecard.seller_percent_ranks(t, p)
    return r.select(
        "seller_id",
        cents_to_double(F.col("total_revenue")).alias("total_revenue"),
        "on_time_rate",
        "avg_review_score",
        "pr_revenue",
        "pr_on_time",
        "pr_review",
    )


def _top(n):
    def top(t, p):
        return scorecard.top_sellers(scorecard.seller_scorecard(t, p), n)

    top.__name__ = f"top_sellers_{n}"
    return top


def _in_output_order(name):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return numbered_for_output(QUERIES[name](spark, sf_dir), name)

    run.__name__ = f"{name}_ordered"
    return run


def _categories(t, p):
    return abc.product_categories(t)


def _checks(fn, with_now=False):
    def run(t, p):
        return fn(t, FIXED_NOW) if with_now else fn(t)

    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # filters
    "delivered_orders": _query(filters.delivered_orders),
    "active_orders": _query(filters.active_orders),
    "orders_date_range": _query(_orders_date_range, DATE_RANGE),
    "orders_by_seller_state": _query(_orders_by_seller_state, BY_STATE),
    # seller scorecard
    "seller_revenue": _query(scorecard.seller_revenue),
    "seller_delivery": _query(scorecard.seller_delivery),
    "seller_reviews": _query(scorecard.seller_reviews),
    "seller_percent_ranks": _query(_seller_percent_ranks),
    "seller_scorecard": _query(scorecard.seller_scorecard),
    "seller_scorecard_by_state": _query(scorecard.seller_scorecard, BY_STATE),
    "seller_scorecard_date_range": _query(scorecard.seller_scorecard, DATE_RANGE),
    "top_sellers": _query(_top(50)),
    "top_sellers_10": _query(_top(10)),
    # ABC classification
    "product_categories": _query(_categories),
    "product_revenue": _query(abc.product_revenue),
    "product_revenue_fanout": _query(abc.product_revenue, fanout=True),
    "product_revenue_share": _query(abc.product_revenue_share),
    "product_cumulative_share": _query(abc.product_cumulative_share),
    "abc_classification": _query(abc.abc_classification),
    "abc_classification_plain": _query(abc.abc_classification, fanout=False),
    "abc_classification_by_state": _query(abc.abc_classification, BY_STATE),
    "abc_classification_date_range": _query(abc.abc_classification, DATE_RANGE),
    "abc_tier_summary": _query(abc.abc_tier_summary),
    # cohort retention
    "customer_first_purchase": _query(cohort.customer_first_purchase),
    "second_purchase": _query(cohort.second_purchase),
    "cohort_retention": _query(cohort.cohort_retention),
    "cohort_retention_by_state": _query(cohort.cohort_retention, BY_STATE),
    "cohort_retention_date_range": _query(cohort.cohort_retention, DATE_RANGE),
    "cohort_retention_long": _query(cohort.cohort_retention_long),
    # delivery
    "order_lead_times": _query(delivery.order_lead_times),
    "delivery_by_state": _query(delivery.delivery_by_state),
    "delivery_in_seller_state": _query(delivery.delivery_by_state, BY_STATE),
    "delivery_date_range": _query(delivery.delivery_by_state, DATE_RANGE),
    "delivery_days_early": _query(delivery.delivery_days_early),
    # monthly revenue
    "monthly_revenue": _query(monthly.monthly_revenue),
    "monthly_growth": _query(monthly.monthly_growth),
    "monthly_growth_by_state": _query(monthly.monthly_growth, BY_STATE),
    "monthly_growth_date_range": _query(monthly.monthly_growth, DATE_RANGE),
    "monthly_series": _query(monthly.monthly_series),
    # data-quality checks
    "check_key_columns": _query(_checks(checks.check_key_columns)),
    "check_row_counts": _query(_checks(checks.check_row_counts)),
    "check_date_range": _query(_checks(checks.check_date_range, with_now=True)),
    "check_summary": _query(_checks(checks.check_summary, with_now=True)),
}

# each analysis in its output order: the rows with their positions
QUERIES |= {f"{name}_ordered": _in_output_order(name) for name in OUTPUT_ORDER}
