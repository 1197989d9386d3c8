"""Cohort retention: first-purchase month and return within 30/60/90 days.

Purchases are active orders (status not canceled/unavailable; NULL status
drops) in range - with a seller state set, only orders holding an in-state
item - joined with customers; the person is ``customer_unique_id`` (one
person may own several ``customer_id``). "First purchase" is the first
within the filter. A return is the earliest purchase strictly after the
first (an order at the same instant does not count), within N days
inclusive. Cohorts near the end of the data have unfinished windows; no
correction is made.

Plan: orders join customers once; equal (person, instant) pairs are collapsed,
combined map-side; each person's instants are ranked and only the first two kept,
which Spark also does per task before the shuffle (a partial group limit), so a
person with a third of all purchases sends two rows per task; minimum and maximum
of those two are the first and second purchase. Counts per cohort month are a
few groups, combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import month_start, round_half_away, safe_div
from mercato.operators.filters import active_orders
from mercato.params import NO_FILTER, Params

# Return windows in days.
WINDOWS = (30, 60, 90)


def purchases(t, params: Params = NO_FILTER) -> DataFrame:
    """``customer_unique_id, ts`` for every qualifying order of a known person."""
    o = active_orders(t, params).select("customer_id", F.col("order_purchase_timestamp").alias("ts"))
    c = t["customers"].select("customer_id", "customer_unique_id")
    return (
        o.join(c, "customer_id")
        .where(F.col("customer_unique_id").isNotNull() & F.col("ts").isNotNull())
        .select("customer_unique_id", "ts")
    )


def customer_first_purchase(t, params: Params = NO_FILTER) -> DataFrame:
    """``customer_unique_id, first_purchase_ts, cohort_month``."""
    p = purchases(t, params)
    return p.groupBy("customer_unique_id").agg(F.min("ts").alias("first_purchase_ts")).select(
        "customer_unique_id", "first_purchase_ts", month_start(F.col("first_purchase_ts")).alias("cohort_month")
    )


def second_purchase(t, params: Params = NO_FILTER) -> DataFrame:
    """``customer_unique_id, cohort_month, first_purchase_ts, second_purchase_ts`` (NULL if none)."""
    instants = purchases(t, params).groupBy("customer_unique_id", "ts").agg(F.count(F.lit(1)).alias("orders"))
    order = Window.partitionBy("customer_unique_id").orderBy("ts")
    # after the collapse no two rows tie, so row numbers are dense ranks
    two = instants.select("customer_unique_id", "ts", F.row_number().over(order).alias("place")).where(F.col("place") <= 2)
    return (
        two.groupBy("customer_unique_id")
        .agg(
            F.min("ts").alias("first_purchase_ts"),
            F.min(F.when(F.col("place") == 2, F.col("ts"))).alias("second_purchase_ts"),
        )
        .select(
            "customer_unique_id",
            month_start(F.col("first_purchase_ts")).alias("cohort_month"),
            "first_purchase_ts",
            "second_purchase_ts",
        )
    )


def _returned(days: int) -> F.Column:
    limit = F.col("first_purchase_ts") + F.make_dt_interval(F.lit(days))
    return F.when(F.col("second_purchase_ts") <= limit, 1).otherwise(0)


def _cohort_counts(t, params: Params, windows) -> DataFrame:
    s = second_purchase(t, params)
    return s.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[F.sum(_returned(d)).cast("long").alias(f"returned_{d}d") for d in windows],
    )


def cohort_retention(t, params: Params = NO_FILTER, windows=WINDOWS) -> DataFrame:
    """``cohort_month, cohort_size, returned_Nd..., retention_Nd_pct... (2 dp)``."""
    c = _cohort_counts(t, params, windows)
    return c.select(
        "cohort_month",
        "cohort_size",
        *[f"returned_{d}d" for d in windows],
        *[
            round_half_away(safe_div(F.col(f"returned_{d}d"), F.col("cohort_size")) * 100, 2).alias(
                f"retention_{d}d_pct"
            )
            for d in windows
        ],
    )


def long_form(retention: DataFrame, windows=WINDOWS) -> DataFrame:
    """A :func:`cohort_retention` result in long form:
    ``cohort_month, window_days, returned, retention_pct``.

    One generator over each cohort row (no union, so the cohort plan runs once).
    """
    series = F.array(
        *[
            F.struct(
                F.lit(d).alias("window_days"),
                F.col(f"returned_{d}d").alias("returned"),
                F.col(f"retention_{d}d_pct").alias("retention_pct"),
            )
            for d in windows
        ]
    )
    return retention.select("cohort_month", F.inline(series))


def cohort_retention_long(t, params: Params = NO_FILTER, windows=WINDOWS) -> DataFrame:
    """Chart data: the three retention series in long form."""
    return long_form(cohort_retention(t, params, windows), windows)
