"""Order and item filters (status, date range, the three seller-state filters).

The seller-state parameter means three different things, on purpose:

* :func:`items_of_state` keeps *items* whose own seller is in the state
  (product revenue);
* :func:`orders_with_seller_in` keeps *whole orders* that contain at least one
  item sold by a seller in the state (cohorts, delivery, monthly revenue);
* :func:`sellers_in` keeps *seller rows* (the scorecard ranks among them).

Filters are added only when a parameter is set, so an unset parameter costs
nothing and Catalyst pushes the ones that are set into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import ts_literal
from mercato.operators.ranking import reliable
from mercato.params import Params
from mercato.sources.schema import PURCHASE_MONTH

# Order states dropped by the cohort analysis.
INACTIVE_STATUSES = ("canceled", "unavailable")
DELIVERED = "delivered"


def delivered(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == DELIVERED)


def active(orders: DataFrame) -> DataFrame:
    """Orders whose status is known and not canceled/unavailable (NULL status drops)."""
    return orders.where(~F.col("order_status").isin(*INACTIVE_STATUSES))


def in_date_range(orders: DataFrame, params: Params) -> DataFrame:
    """Orders placed in the range; of orders stored by month only its months are read."""
    ts, by_month = F.col("order_purchase_timestamp"), PURCHASE_MONTH in orders.columns
    if params.start is not None:
        orders = orders.where(ts >= ts_literal(params.start))
        if by_month:
            orders = orders.where(F.col(PURCHASE_MONTH) >= params.start.year * 100 + params.start.month)
    if params.end is not None:
        orders = orders.where(ts <= ts_literal(params.end))
        if by_month:
            orders = orders.where(F.col(PURCHASE_MONTH) <= params.end.year * 100 + params.end.month)
    return orders


def sellers_in(sellers: DataFrame, state: str | None) -> DataFrame:
    if not state:
        return sellers
    return sellers.where(F.col("seller_state") == state)


def items_of_state(items: DataFrame, sellers: DataFrame, state: str | None) -> DataFrame:
    """Items whose seller is in ``state``; all items when no state is set."""
    if not state:
        return items
    return items.join(sellers_in(sellers, state).select("seller_id"), "seller_id", "left_semi")


def order_ids_with_seller_in(items: DataFrame, sellers: DataFrame, state: str) -> DataFrame:
    """Distinct ``order_id`` of orders holding an item of a seller in ``state``.

    The distinct is partially aggregated before its shuffle, so an order
    with a huge number of items collapses to one row per map task.
    """
    return items_of_state(items.select("order_id", "seller_id"), sellers, state).select("order_id").distinct()


def orders_with_seller_in(orders: DataFrame, items: DataFrame, sellers: DataFrame, state: str | None) -> DataFrame:
    """Whole orders with at least one item by a seller in ``state`` (all if unset)."""
    if not state:
        return orders
    return orders.join(order_ids_with_seller_in(items, sellers, state), "order_id", "left_semi")


def delivered_orders(t, params: Params) -> DataFrame:
    """Delivered orders in the date range (the first step of three analyses)."""
    return in_date_range(delivered(t["orders"]), params)


def active_orders(t, params: Params) -> DataFrame:
    """Active orders in the date range, restricted to orders with an in-state seller."""
    o = in_date_range(active(t["orders"]), params)
    return orders_with_seller_in(o, t["order_items"], t["sellers"], params.state)


def reviews_per_order(t) -> DataFrame:
    return t["order_reviews"].groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"),
        F.count(F.lit(1)).alias("review_n"),
    )


def items_per_order(t) -> DataFrame:
    return t["order_items"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))


def order_frame(t, params: Params, reviews: bool = False, weights: bool = False) -> DataFrame:
    """Delivered orders in the date range, one row each, written to the checkpoint folder.

    With the order's timestamps; ``reviews`` adds its review sums, ``weights``
    its number of items. The aggregates below it combine map-side, so an
    order that holds a third of all items or reviews is a few rows here. The
    items then join this stored frame directly, each side behind a shuffle of
    its own: the shape in which adaptive execution splits a hot order.
    """
    orders = delivered_orders(t, params).select(
        "order_id", "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
    if reviews:
        orders = orders.join(reviews_per_order(t), "order_id", "left")
    if weights:
        orders = orders.join(items_per_order(t), "order_id", "left")
    return reliable(orders)


def with_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The one large join: items with the columns of their order."""
    return items.join(orders, "order_id")
