"""One key holding a third of all rows: results must not change when the
adaptive planner splits the hot partition."""

import re

import pytest

from conftest import money, ts
from mercato.operators import abc, cohort, monthly, scorecard
from mercato.params import NO_FILTER, Params

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _tables(make_tables, n=300):
    orders, customers, items = [], [], []
    for i in range(n):
        day = 1 + i % 28
        orders.append((i, i, "delivered", ts(f"2020-0{1 + i % 3}-{day:02d} 10:00:00"),
                       ts(f"2020-0{1 + i % 3}-{day:02d} 20:00:00"), ts(f"2020-0{1 + i % 3}-{day:02d} 23:00:00")))
        # person 7 owns a third of all orders; everyone else one or two
        customers.append((i, 7 if i % 3 == 0 else 1000 + i // 2, "S"))
        items.append((i, i % 5, 1 if i % 3 == 0 else 2 + i % 4, money(10 + i % 7), money(1)))
    # order 0 holds a third of all items
    # (different prices, or the hot partition compresses to next to nothing)
    items += [(0, 9 + k % 97, 1, money(5 + (k * 7919) % 10_007), money(k % 13)) for k in range(4 * n)]
    return make_tables(orders=orders, customers=customers, order_items=items,
                       sellers=[(s, "S", f"c{s}") for s in range(1, 6)], order_reviews=[(0, 5), (1, 4)])


def _collect(df):
    return sorted(tuple(r) for r in df.collect())


QUERIES = {
    "cohort": lambda t: cohort.cohort_retention(t),
    "second": lambda t: cohort.second_purchase(t),
    "monthly": lambda t: monthly.monthly_growth(t),
    "monthly by state": lambda t: monthly.monthly_growth(t, Params(seller_state="S")),
    "scorecard": lambda t: scorecard.seller_scorecard(t),
    "abc": lambda t: abc.abc_classification(t),
}


def test_results_unchanged_under_skew_split(spark, make_tables, skew_conf):
    t = _tables(make_tables)
    split = {k: _collect(q(t)) for k, q in QUERIES.items()}
    for k in SKEW_CONF:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = {k: _collect(q(t)) for k, q in QUERIES.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert split == plain
    hot = [r for r in cohort.second_purchase(t).collect() if r["customer_unique_id"] == 7]
    assert len(hot) == 1 and hot[0]["second_purchase_ts"] is not None


def _joins(df) -> list[str]:
    """The join nodes of the plan that ran, with their keys."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]


@pytest.mark.parametrize("build", [
    lambda t: scorecard.seller_metrics(t),
    lambda t: abc._product_revenue_exact(t, NO_FILTER, True),
    lambda t: monthly._monthly_exact(t, NO_FILTER),
    lambda t: monthly._monthly_exact(t, Params(seller_state="S")),
], ids=["scorecard", "abc fan-out", "monthly", "monthly by state"])
def test_the_join_on_the_hot_order_is_split(spark, make_tables, skew_conf, build):
    joins = [j for j in _joins(build(_tables(make_tables))) if re.search(r"\[order_id#\d+L?\], \[order_id#\d+L?\], Inner", j)]
    assert len(joins) == 1 and "skew=true" in joins[0], joins


def test_a_hot_person_is_limited_before_its_shuffle(spark, make_tables, skew_conf):
    df = cohort.second_purchase(_tables(make_tables))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [line.strip() for line in plan.splitlines()]
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    by_person = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(customer_unique_id#\d+L?, \d+\)", line)]
    # the limit stands below (after, in the printed tree) the only exchange by person
    assert len(by_person) == 1 and by_person[0] < partial
    # no join by person is left
    assert not [j for j in _joins(df) if "customer_unique_id" in j]
