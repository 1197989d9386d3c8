"""Order lines: the items of a run's orders, read and joined once for three analyses.

The scorecard, ABC and monthly revenue all need delivered orders with their
items. A line is one row per (order, seller, product) with its number of items
and sums, plus what the analyses need of its order. The items meet the stored
order-level frame in the one large join, each side directly behind a shuffle of
its own, so adaptive execution splits a hot order; the lines are combined on
that join's partitioning and stored. From then on everything is a combined
aggregate over the stored lines, and ``order_items`` is not read again:

* per seller: sums, and distinct orders (spread over (seller, order));
* per product: sums weighted with the items of the line's order, which come
  from an aggregate of the lines joined back on the order;
* per month: see :mod:`mercato.operators.monthly`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import day_diff, month_start, safe_div, to_cents
from mercato.operators.filters import order_frame, with_orders
from mercato.operators.ranking import reliable
from mercato.params import Params

REVIEWS = ("score_sum", "score_n", "review_n")


def order_lines(t, params: Params, reviews: bool = True) -> DataFrame:
    """Stored lines of the delivered orders in the date range; ``reviews`` adds their review sums.

    ``order_id, seller_id, product_id, month, days_early, on_time, n, cents``
    (price), ``amount`` (price plus freight) ``[, score_sum, score_n, review_n]``.
    """
    orders = order_frame(t, params, reviews=reviews)
    delivered_at, estimated_at = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    kept = REVIEWS if reviews else ()
    orders = orders.select(
        "order_id",
        month_start(F.col("order_purchase_timestamp")).alias("month"),
        F.when(delivered_at.isNotNull() & estimated_at.isNotNull(), day_diff(delivered_at, estimated_at)).alias("days_early"),
        F.when(delivered_at <= estimated_at, 1).otherwise(0).alias("on_time"),
        *kept,
    )
    items = t["order_items"].select(
        "order_id", "seller_id", "product_id", to_cents(F.col("price")).alias("cents"),
        to_cents(F.col("price") + F.col("freight_value")).alias("amount"))
    lines = with_orders(items, orders).groupBy("order_id", "seller_id", "product_id").agg(
        *[F.first(c).alias(c) for c in ("month", "days_early", "on_time", *kept)],  # one value per order
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"), F.sum("amount").alias("amount"))
    return reliable(lines)


def metrics_by_seller(lines: DataFrame) -> DataFrame:
    """The columns of :func:`~mercato.operators.scorecard.seller_metrics` from lines with reviews."""
    n = F.col("n")
    known = F.sum(F.when(F.col("days_early").isNotNull(), n))
    return lines.groupBy("seller_id").agg(
        F.sum("amount").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        safe_div(F.sum(F.col("days_early") * n), known).alias("avg_days_early"),
        F.sum(F.col("on_time") * n).alias("on_time_items"),
        F.sum(n).alias("items"),
        *[F.sum(F.col(c) * n).alias(c) for c in REVIEWS],
    )


def revenue_by_product(lines: DataFrame, of: DataFrame, fanout: bool) -> DataFrame:
    """``product_id, revenue (cents), units_sold`` of the lines ``of``; ``fanout`` weights each item with
    the number of items in its order, counted over all ``lines``."""
    n, cents = F.col("n"), F.col("cents")
    if fanout:
        items = lines.groupBy("order_id").agg(F.sum("n").alias("n_items"))
        of = of.select("order_id", "product_id", "n", "cents").join(items, "order_id")
        n, cents = n * F.col("n_items"), cents * F.col("n_items")
    return of.groupBy("product_id").agg(F.sum(cents).alias("revenue"), F.sum(n).alias("units_sold"))
