"""Delivery performance by customer state: actual vs promised lead times.

Delivered orders with both dates, in range (with a seller state set, only
orders holding an in-state item), joined with customers. Day counts are
calendar days (midnights crossed). On time here is day-level
(``days_early >= 0``), unlike the scorecard's timestamp-level comparison, so
a parcel arriving later on the estimated day is on time here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import day_diff, round_half_away, safe_div
from mercato.operators.filters import delivered, in_date_range, orders_with_seller_in
from mercato.params import NO_FILTER, Params

# Fixed value: states with fewer delivered orders are left out.
MIN_ORDERS = 10


def order_lead_times(t, params: Params = NO_FILTER) -> DataFrame:
    """``order_id, customer_id, order_purchase_timestamp, order_delivered_customer_date,
    order_estimated_delivery_date, actual_days, estimated_days, days_early``."""
    o = delivered(t["orders"]).where(
        F.col("order_delivered_customer_date").isNotNull() & F.col("order_estimated_delivery_date").isNotNull()
    )
    o = in_date_range(o, params)
    o = orders_with_seller_in(o, t["order_items"], t["sellers"], params.state)
    bought, arrived, promised = (
        F.col("order_purchase_timestamp"),
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )
    return o.select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        day_diff(bought, arrived).alias("actual_days"),
        day_diff(bought, promised).alias("estimated_days"),
        day_diff(arrived, promised).alias("days_early"),
    )


def delivery_by_state(t, params: Params = NO_FILTER, min_orders: int = MIN_ORDERS) -> DataFrame:
    """``state, order_count, avg_actual_days, avg_estimated_days, avg_days_early,
    stddev_actual_days (1 dp each), on_time_pct (unrounded), min_actual_days,
    max_actual_days`` for states with at least ``min_orders`` orders."""
    lead = order_lead_times(t, params).select("customer_id", "actual_days", "estimated_days", "days_early")
    geo = lead.join(t["customers"].select("customer_id", "customer_state"), "customer_id")
    agg = geo.groupBy(F.col("customer_state").alias("state")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.avg("actual_days").alias("avg_actual_days"),
        F.avg("estimated_days").alias("avg_estimated_days"),
        F.avg("days_early").alias("avg_days_early"),
        F.sum("actual_days").alias("days"),
        F.sum(F.col("actual_days").cast("long") * F.col("actual_days")).alias("days_squared"),
        F.sum(F.when(F.col("days_early") >= 0, 1).otherwise(0)).alias("on_time"),
        F.min("actual_days").cast("long").alias("min_actual_days"),
        F.max("actual_days").cast("long").alias("max_actual_days"),
    )
    # from exact whole sums, so the result does not depend on the order of merging:
    # (n * sum(d^2) - sum(d)^2) / (n * (n - 1))
    n = F.col("order_count").cast("decimal(19,0)")
    spread = n * F.col("days_squared").cast("decimal(19,0)") - F.col("days").cast("decimal(19,0)") * F.col("days").cast("decimal(19,0)")
    pairs = F.col("order_count").cast("double") * (F.col("order_count") - 1).cast("double")
    agg = agg.withColumn("stddev_actual_days", F.sqrt(safe_div(spread, pairs)))
    return agg.where(F.col("order_count") >= min_orders).select(
        "state",
        "order_count",
        round_half_away(F.col("avg_actual_days"), 1).alias("avg_actual_days"),
        round_half_away(F.col("avg_estimated_days"), 1).alias("avg_estimated_days"),
        round_half_away(F.col("avg_days_early"), 1).alias("avg_days_early"),
        round_half_away(F.col("stddev_actual_days"), 1).alias("stddev_actual_days"),
        (F.col("on_time").cast("double") / F.col("order_count").cast("double") * 100).alias("on_time_pct"),
        "min_actual_days",
        "max_actual_days",
    )


def days_early_of(by_state: DataFrame) -> DataFrame:
    return by_state.select("state", "avg_days_early")


def delivery_days_early(t, params: Params = NO_FILTER) -> DataFrame:
    """Chart data: ``state, avg_days_early``."""
    return days_early_of(delivery_by_state(t, params))
