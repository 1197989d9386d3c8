"""Seller scorecard: revenue, delivery and reviews, ranked into one score.

Plan: an order-level frame (delivered orders in range with their review sums,
one row per order, :func:`~mercato.operators.filters.order_frame`) is stored
first; the items, restricted to the state's sellers when one is set, join it once
on ``order_id``. One aggregate per seller then yields every metric:

* revenue (price + freight, exact, in long cents) and distinct orders;
* average days early over items with both dates, and the on-time rate over
  all items - an item without a delivery date counts as late;
* average review score weighted per item x review pair: sum of scores over
  count of scores, both summed over items (integers, so exact).

Percent ranks over sellers use :mod:`mercato.operators.ranking` (no
single-task window). The seller table is filtered by state before ranking,
so ranks are among the sellers of that state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import cents_to_double, day_diff, round_half_away, safe_div, to_cents
from mercato.operators.filters import items_of_state, order_frame, sellers_in, with_orders
from mercato.operators.order_lines import metrics_by_seller
from mercato.operators.ranking import percent_ranks, reliable
from mercato.params import NO_FILTER, Params

# Composite weights for revenue, on-time rate and review score.
WEIGHTS = (0.40, 0.30, 0.30)


def seller_metrics(t, params: Params = NO_FILTER, lines: DataFrame | None = None) -> DataFrame:
    """Per seller with delivered orders: exact sums behind every metric.

    ``lines`` are a run's :func:`~mercato.operators.order_lines.order_lines`
    with reviews; without them the items are joined here. With a seller state set, only that state's
    sellers are ranked and a seller's metrics depend only on its own items, so
    the items are restricted to in-state sellers before the join.
    """
    if lines is not None:
        return metrics_by_seller(items_of_state(lines, t["sellers"], params.state))
    orders = order_frame(t, params, reviews=True)
    items = t["order_items"].select("order_id", "seller_id", "price", "freight_value")
    base = with_orders(items_of_state(items, t["sellers"], params.state), orders)
    delivered_at = F.col("order_delivered_customer_date")
    estimated_at = F.col("order_estimated_delivery_date")
    rows = base.select(
        "order_id",
        "seller_id",
        "score_sum",
        "score_n",
        "review_n",
        to_cents(F.col("price") + F.col("freight_value")).alias("amount"),
        F.when(delivered_at.isNotNull() & estimated_at.isNotNull(), day_diff(delivered_at, estimated_at)).alias(
            "days_early"
        ),
        # an item without a delivery date counts as late
        F.when(delivered_at <= estimated_at, 1).otherwise(0).alias("on_time"),
    )
    return rows.groupBy("seller_id").agg(
        F.sum("amount").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        F.avg("days_early").alias("avg_days_early"),
        F.sum("on_time").alias("on_time_items"),
        F.count(F.lit(1)).alias("items"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("score_n").alias("score_n"),
        F.sum("review_n").alias("review_n"),
    )


def seller_revenue(t, params: Params = NO_FILTER) -> DataFrame:
    """``seller_id, total_revenue (double), total_orders`` over delivered orders."""
    m = seller_metrics(t, params)
    return m.select("seller_id", cents_to_double(F.col("total_revenue")).alias("total_revenue"), "total_orders")


def seller_delivery(t, params: Params = NO_FILTER) -> DataFrame:
    """``seller_id, avg_days_early, on_time_rate`` (item-weighted, unrounded)."""
    m = seller_metrics(t, params)
    return m.select("seller_id", "avg_days_early", safe_div(F.col("on_time_items"), F.col("items")).alias("on_time_rate"))


def seller_reviews(t, params: Params = NO_FILTER) -> DataFrame:
    """``seller_id, avg_review_score`` for sellers with at least one reviewed order."""
    m = seller_metrics(t, params).where(F.col("review_n") > 0)
    return m.select("seller_id", safe_div(F.col("score_sum"), F.col("score_n")).alias("avg_review_score"))


def seller_combined(t, params: Params = NO_FILTER, lines: DataFrame | None = None) -> DataFrame:
    """Sellers (of the state, if set) with at least one order, metrics defaulted to 0."""
    m = seller_metrics(t, params, lines)
    sellers = sellers_in(t["sellers"], params.state).select("seller_id", "seller_state", "seller_city")
    return sellers.join(m, "seller_id").where(F.col("total_orders") > 0).select(
        "seller_id",
        "seller_state",
        "seller_city",
        F.coalesce(F.col("total_revenue"), F.lit(0).cast("long")).alias("total_revenue"),  # cents
        "total_orders",
        F.coalesce(safe_div(F.col("on_time_items"), F.col("items")), F.lit(0.0)).alias("on_time_rate"),
        F.coalesce(F.col("avg_days_early"), F.lit(0.0)).alias("avg_days_early"),
        F.coalesce(safe_div(F.col("score_sum"), F.col("score_n")), F.lit(0.0)).alias("avg_review_score"),
    )


def seller_percent_ranks(
    t, params: Params = NO_FILTER, plain: bool = False, lines: DataFrame | None = None
) -> DataFrame:
    """Combined sellers plus ``pr_revenue, pr_on_time, pr_review`` in [0, 1]."""
    c = seller_combined(t, params, lines)
    if not plain:
        c = reliable(c)  # read by the ranking jobs and the final joins: compute it once
    ranks = {"total_revenue": "pr_revenue", "on_time_rate": "pr_on_time", "avg_review_score": "pr_review"}
    return percent_ranks(c, ranks, plain=plain, checkpointed=True)


def seller_scorecard(
    t, params: Params = NO_FILTER, weights=WEIGHTS, plain: bool = False, lines: DataFrame | None = None
) -> DataFrame:
    """One row per ranked seller.

    ``seller_id, seller_state, seller_city, total_revenue (unrounded),
    total_orders, on_time_pct (1 dp), avg_days_early (1), avg_review_score
    (2), composite_score (1)``; composite = 100 x weighted sum of the three
    percent ranks. Sellers with no orders in range are left out; sellers
    without reviews score 0 on reviews.
    """
    w_rev, w_on, w_review = weights
    r = seller_percent_ranks(t, params, plain=plain, lines=lines)
    composite = (F.col("pr_revenue") * w_rev + F.col("pr_on_time") * w_on + F.col("pr_review") * w_review) * 100
    return r.select(
        "seller_id",
        "seller_state",
        "seller_city",
        cents_to_double(F.col("total_revenue")).alias("total_revenue"),
        "total_orders",
        round_half_away(F.col("on_time_rate") * 100, 1).alias("on_time_pct"),
        round_half_away(F.col("avg_days_early"), 1).alias("avg_days_early"),
        round_half_away(F.col("avg_review_score"), 2).alias("avg_review_score"),
        round_half_away(composite, 1).alias("composite_score"),
    )


def top_sellers(scorecard: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` best sellers by composite score (ties broken by ``seller_id``)."""
    return scorecard.orderBy(F.col("composite_score").desc_nulls_last(), F.col("seller_id").asc()).limit(n)
