"""ABC (Pareto) classification of products by revenue.

Revenue is the sum of item prices (no freight) over delivered orders in
range; with a seller state set, only items whose own seller is in the state
count. The reference joins the items to *all* items of their order and never
uses the second side, so each item counts once per item in its order
(``fanout=True``, the parity default). Here that is a weight, the number of
items of the order, held by the stored order-level frame
(:func:`~mercato.operators.filters.order_frame`) that the items join once: no
self-join, no pairs. Money is summed as ``long`` cents (exact).
``fanout=False`` gives the plain revenue.

Shares are against the grand total of the filtered set; the cumulative share
is a running sum in descending revenue order where tied products share the
value (RANGE frame), computed by :func:`mercato.operators.ranking.running_share`
without a single-task window. Tiers are decided on the unrounded cumulative
share: up to 0.80 is A, up to 0.95 is B, the rest C. The product that crosses
0.80 is therefore already B.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import cents_to_double, round_half_away, safe_div, to_cents
from mercato.operators.filters import delivered_orders, items_of_state, order_frame, with_orders
from mercato.operators.order_lines import revenue_by_product
from mercato.operators.ranking import reliable, running_share
from mercato.params import NO_FILTER, Params

# Cumulative-share cut points of tiers A and B.
CUTS = (0.80, 0.95)


def product_categories(t) -> DataFrame:
    """``product_id, category``: English name, else the original, else 'Unknown'."""
    p = t["products"].select("product_id", "product_category_name")
    ct = t["category_translation"]
    return p.join(ct, "product_category_name", "left").select(
        "product_id",
        F.coalesce(F.col("product_category_name_english"), F.col("product_category_name"), F.lit("Unknown")).alias(
            "category"
        ),
    )


def _product_revenue_exact(t, params: Params, fanout: bool, lines: DataFrame | None = None) -> DataFrame:
    if lines is not None:
        return revenue_by_product(lines, items_of_state(lines, t["sellers"], params.state), fanout)
    orders = order_frame(t, params, weights=True) if fanout else delivered_orders(t, params).select("order_id")
    items = items_of_state(t["order_items"], t["sellers"], params.state) if params.state else t["order_items"]
    items = items.select("order_id", "product_id", to_cents(F.col("price")).alias("cents"))
    if fanout:
        j = with_orders(items, orders.select("order_id", "n_items"))
        return j.groupBy("product_id").agg(
            F.sum(F.col("cents") * F.col("n_items")).alias("revenue"), F.sum("n_items").alias("units_sold")
        )
    j = with_orders(items, orders.select("order_id"))
    return j.groupBy("product_id").agg(F.sum("cents").alias("revenue"), F.count(F.lit(1)).alias("units_sold"))


def product_revenue(t, params: Params = NO_FILTER, fanout: bool = False) -> DataFrame:
    """``product_id, revenue (double), units_sold``; plain unless ``fanout``."""
    r = _product_revenue_exact(t, params, fanout)
    return r.select("product_id", cents_to_double(F.col("revenue")).alias("revenue"), "units_sold")


def product_shares(
    t, params: Params = NO_FILTER, fanout: bool = True, plain: bool = False, lines: DataFrame | None = None,
    categories: bool = False,
) -> DataFrame:
    """``product_id, revenue (long cents), units_sold, revenue_share, cumulative_share``.

    ``categories`` adds the category, joined while the aggregate is still
    partitioned by product.
    """
    r = _product_revenue_exact(t, params, fanout, lines)
    if categories:
        r = r.join(product_categories(t), "product_id", "left")
    if not plain:
        r = reliable(r)  # ranked and joined back: compute the joins once
    return running_share(
        r, "revenue", "cumulative_share", share="revenue_share", plain=plain, checkpointed=True, to_double=cents_to_double
    )


def product_revenue_share(t, params: Params = NO_FILTER, fanout: bool = True) -> DataFrame:
    s = product_shares(t, params, fanout)
    return s.select("product_id", cents_to_double(F.col("revenue")).alias("revenue"), "revenue_share")


def product_cumulative_share(t, params: Params = NO_FILTER, fanout: bool = True) -> DataFrame:
    s = product_shares(t, params, fanout)
    return s.select("product_id", cents_to_double(F.col("revenue")).alias("revenue"), "cumulative_share")


def abc_detail(
    t, params: Params = NO_FILTER, fanout: bool = True, cuts=CUTS, plain: bool = False, lines: DataFrame | None = None
) -> DataFrame:
    """Unrounded classification (input to the report tables)."""
    a, b = cuts
    s = product_shares(t, params, fanout, plain=plain, lines=lines, categories=True)
    cum = F.col("cumulative_share")
    return s.select(
        "product_id",
        F.coalesce(F.col("category"), F.lit("Unknown")).alias("category"),
        "revenue",
        "units_sold",
        "revenue_share",
        "cumulative_share",
        F.when(cum <= a, "A").when(cum <= b, "B").otherwise("C").alias("abc_class"),
    )


def abc_classification(
    t, params: Params = NO_FILTER, fanout: bool = True, cuts=CUTS, plain: bool = False, lines: DataFrame | None = None
) -> DataFrame:
    """``product_id, category, revenue (2), units_sold, revenue_share_pct (4),
    cumulative_share_pct (2), abc_class``."""
    d = abc_detail(t, params, fanout, cuts, plain=plain, lines=lines)
    return d.select(
        "product_id",
        "category",
        cents_to_double(F.col("revenue")).alias("revenue"),
        "units_sold",
        round_half_away(F.col("revenue_share") * 100, 4).alias("revenue_share_pct"),
        round_half_away(F.col("cumulative_share") * 100, 2).alias("cumulative_share_pct"),
        "abc_class",
    )


def summarize_tiers(classification: DataFrame) -> DataFrame:
    """Per tier of an :func:`abc_classification` result: ``abc_class, product_count,
    revenue (2), units_sold, revenue_share_pct (2)``.

    Works on the rounded output (as written to ``detail.parquet``): revenue
    there is a whole number of cents, recovered exactly before summing.
    """
    cents = F.round(F.col("revenue") * 100).cast("long")
    tiers = classification.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum(cents).alias("revenue"),
        F.sum("units_sold").alias("units_sold"),
    )
    # at most three rows: the grand total over them is a tiny window
    total = F.sum("revenue").over(Window.partitionBy())
    return tiers.select(
        "abc_class",
        "product_count",
        cents_to_double(F.col("revenue")).alias("revenue"),
        "units_sold",
        round_half_away(safe_div(cents_to_double(F.col("revenue")), cents_to_double(total)) * 100, 2).alias(
            "revenue_share_pct"
        ),
    )


def abc_tier_summary(t, params: Params = NO_FILTER, fanout: bool = True) -> DataFrame:
    """Tier summary of :func:`abc_classification` (see :func:`summarize_tiers`)."""
    return summarize_tiers(abc_classification(t, params, fanout))
