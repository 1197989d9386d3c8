"""Monthly revenue trend and month-over-month growth.

Plan: delivered orders in range are joined with their items once, on
``order_id``. With a seller state set, the *orders* are first restricted to those
holding an in-state item and stored (one row per order), so the items still join
a frame that lies directly behind a shuffle and a hot order can be split.

An order has one month, so its rows collapse to one per (order, seller) on the
join's own partitioning, without a shuffle, and the first of them stands for the
order. Counting those per (month, seller), combined map-side, gives both distinct
counts exactly: an order's first row is one order, a row per (month, seller) one
seller. No row is expanded. The growth window then runs over one row per month,
which is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import cents_to_double, month_label, month_start, round_half_away, safe_div, to_cents
from mercato.operators.filters import delivered_orders, order_ids_with_seller_in, orders_with_seller_in, with_orders
from mercato.operators.ranking import reliable
from mercato.params import NO_FILTER, Params


def _by_month(rows: DataFrame) -> DataFrame:
    """``month, revenue, order_count, active_sellers`` of rows ``order_id, seller_id, month, amount``.

    An order holds one row per seller when it meets the window, however many items it has.
    """
    pairs = rows.groupBy("order_id", "seller_id").agg(F.first("month").alias("month"), F.sum("amount").alias("amount"))
    first = F.row_number().over(Window.partitionBy("order_id").orderBy("seller_id")) == 1
    by_seller = pairs.withColumn("first", first.cast("int")).groupBy("month", "seller_id").agg(
        F.sum("amount").alias("amount"), F.sum("first").alias("orders"))
    return by_seller.groupBy("month").agg(
        F.sum("amount").alias("revenue"),
        F.sum("orders").alias("order_count"),
        F.count("seller_id").alias("active_sellers"),  # a null seller is none
    )


def _monthly_exact(t, params: Params, lines: DataFrame | None = None) -> DataFrame:
    """``month, revenue (long cents, exact), order_count, active_sellers``.

    Revenue is price plus freight. With a seller state set, an order with
    one in-state item contributes all its items and sellers. ``lines`` are a run's
    :func:`~mercato.operators.order_lines.order_lines`; without them the items are joined here.
    """
    if lines is not None:
        if params.state:
            lines = lines.join(order_ids_with_seller_in(lines, t["sellers"], params.state), "order_id", "left_semi")
        return _by_month(lines.select("order_id", "seller_id", "month", "amount"))
    orders = delivered_orders(t, params).select("order_id", "order_purchase_timestamp")
    if params.state:
        orders = reliable(orders_with_seller_in(orders, t["order_items"], t["sellers"], params.state))
    base = with_orders(t["order_items"].select("order_id", "seller_id", "price", "freight_value"), orders)
    return _by_month(base.select(
        "order_id",
        "seller_id",
        month_start(F.col("order_purchase_timestamp")).alias("month"),
        to_cents(F.col("price") + F.col("freight_value")).alias("amount"),
    ))


def monthly_revenue(t, params: Params = NO_FILTER, lines: DataFrame | None = None) -> DataFrame:
    """``month, revenue (double, unrounded), order_count, active_sellers``."""
    m = _monthly_exact(t, params, lines)
    return m.select("month", cents_to_double(F.col("revenue")).alias("revenue"), "order_count", "active_sellers")


def monthly_growth(t, params: Params = NO_FILTER, lines: DataFrame | None = None) -> DataFrame:
    """``month, revenue, order_count, active_sellers, mom_growth_pct``.

    Growth compares with the previous *present* month (a month without
    delivered orders is skipped, not zero), from unrounded revenue; NULL in
    the first month and when the previous revenue is 0. Rounded: revenue to
    2 decimals, growth to 1.
    """
    m = _monthly_exact(t, params, lines)
    w = Window.orderBy(F.col("month").asc_nulls_last())
    m = m.withColumn("prev", F.lag("revenue").over(w))
    # exact difference first, then both operands as double amounts
    growth = safe_div(cents_to_double(F.col("revenue") - F.col("prev")), cents_to_double(F.col("prev"))) * 100
    return m.select(
        "month",
        cents_to_double(F.col("revenue")).alias("revenue"),
        "order_count",
        "active_sellers",
        round_half_away(growth, 1).alias("mom_growth_pct"),
    )


def series_of(growth: DataFrame) -> DataFrame:
    """A :func:`monthly_growth` result with a ``yyyy-MM`` month label, as charted."""
    return growth.select(
        month_label(F.col("month")).alias("month_label"), "revenue", "order_count", "mom_growth_pct"
    )


def monthly_series(t, params: Params = NO_FILTER) -> DataFrame:
    """Chart data: the growth table with a ``yyyy-MM`` month label."""
    return series_of(monthly_growth(t, params))
