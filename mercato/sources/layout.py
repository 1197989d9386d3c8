"""Orders stored by month of purchase, so that a date range reads only its months.

:func:`write_orders_by_month` writes a folder per month; :class:`Tables` reads the
result like any other ``orders`` and keeps the folders' column, and
:func:`mercato.operators.filters.in_date_range` then filters by month besides the
instant: Spark lists and opens only the months of the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.sources.schema import PURCHASE_MONTH, conform
from mercato.sources.sinks import replace_parquet


def month_number(instant: Column) -> Column:
    """Year and month as one integer, 201803 for March 2018; NULL without an instant."""
    return F.year(instant) * 100 + F.month(instant)


def write_orders_by_month(orders: DataFrame, path: str) -> bool:
    """Write ``orders`` (declared columns) as parquet in a folder per month; returns False (``path`` left as it is) when empty.

    Rows go to tasks by ranges of (instant, order), so a task writes few
    months, a month with a large share of the rows is written by several tasks,
    and so are the orders without an instant, which have a folder of their own.
    """
    rows = conform(orders, "orders").drop(PURCHASE_MONTH)
    instant = F.col("order_purchase_timestamp")
    rows = rows.withColumn(PURCHASE_MONTH, month_number(instant)).repartitionByRange(instant, "order_id")
    return replace_parquet(rows, path, by=[PURCHASE_MONTH])
