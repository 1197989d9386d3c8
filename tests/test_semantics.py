"""Hand-made fixtures for the semantic traps (FIXTURES.md section 3)."""

import datetime as dt

import pytest

from conftest import money, ts
from mercato.operators import abc, checks, cohort, delivery, monthly, scorecard
from mercato.params import Params

D = "delivered"


def order(oid, purchase, delivered=None, estimated=None, status=D, customer=None):
    return (oid, customer if customer is not None else oid, status, ts(purchase) if purchase else None,
            ts(delivered) if delivered else None, ts(estimated) if estimated else None)


def item(oid, pid, sid, price, freight=0):
    return (oid, pid, sid, money(price), money(freight))


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


# --- ABC ----------------------------------------------------------------------------
def test_fanout_triples_revenue_and_units(make_tables):  # T1
    t = make_tables(orders=[order(1, "2020-01-05")], order_items=[item(1, 10, 1, 5), item(1, 11, 1, 7), item(1, 12, 1, 9)])
    fan = rows(abc.product_revenue(t, fanout=True), "product_id")
    plain = rows(abc.product_revenue(t, fanout=False), "product_id")
    assert fan[10]["revenue"] == 15.0 and fan[10]["units_sold"] == 3
    assert plain[10]["revenue"] == 5.0 and plain[10]["units_sold"] == 1


def test_crossing_product_leaves_tier_a_and_ties_share(make_tables):  # T2
    # one order per item so the fan-out weight is 1
    prices = {1: 81, 2: 5, 3: 5, 4: 4, 5: 3, 6: 2}
    t = make_tables(
        orders=[order(p, "2020-01-05") for p in prices],
        order_items=[item(p, p, 1, v) for p, v in prices.items()],
        products=[(1, "toys")],
        category_translation=[("toys", "Toys")],
    )
    r = rows(abc.abc_classification(t), "product_id")
    assert r[1]["abc_class"] == "B"  # its own share already crosses 0.80
    assert r[2]["cumulative_share_pct"] == r[3]["cumulative_share_pct"] == 91.0  # tied: same RANGE value
    assert r[2]["abc_class"] == r[3]["abc_class"] == "B"
    assert r[4]["abc_class"] == "B" and r[5]["abc_class"] == "C"  # 95% exactly is B; 98% is C
    assert r[1]["category"] == "Toys" and r[2]["category"] == "Unknown"
    assert abs(sum(v["revenue_share_pct"] for v in r.values()) - 100) < 1e-9


def test_zero_total_revenue_does_not_raise(make_tables):  # T10
    t = make_tables(orders=[order(1, "2020-01-05")], order_items=[item(1, 10, 1, 0)])
    r = abc.abc_classification(t).first()
    assert r["revenue_share_pct"] is None and r["abc_class"] == "C"


# --- scorecard --------------------------------------------------------------------------
def test_review_weighting_and_defaults(make_tables):  # T3, T15, T19, K3
    t = make_tables(
        orders=[
            order(1, "2020-01-05", "2020-01-09 10:00:00", "2020-01-09"),  # later on the estimated day: late
            order(2, "2020-01-06", None, "2020-01-20"),  # no delivery date: late, no days
            order(3, "2020-01-07", "2020-01-08", "2020-01-10"),
        ],
        order_items=[item(1, 10, 1, 10), item(1, 11, 1, 10), item(2, 10, 2, 10), item(3, 12, 1, 10)],
        order_reviews=[(1, 5), (1, 1), (3, 2)],
        sellers=[(1, "S1", "c1"), (2, "S2", "c2"), (3, "S1", "c3")],  # seller 3: no orders
    )
    sc = rows(scorecard.seller_scorecard(t), "seller_id")
    assert set(sc) == {1, 2}  # T19: seller without orders dropped
    # T3: order 1 has two items x two reviews (5,1) -> 4 pairs; order 3 one pair (2): (5+1)*2+2 = 14 / 5
    assert sc[1]["avg_review_score"] == 2.8
    assert sc[2]["avg_review_score"] == 0.0  # T15: no review -> 0
    assert sc[1]["on_time_pct"] == pytest.approx(33.3)  # 1 of 3 items on time (K3: timestamp level)
    assert sc[2]["on_time_pct"] == 0.0 and sc[2]["avg_days_early"] == 0.0
    assert sc[1]["total_orders"] == 2 and sc[1]["total_revenue"] == 30.0


def test_single_seller_ranks_zero(make_tables):  # W1
    t = make_tables(orders=[order(1, "2020-01-05", "2020-01-06", "2020-01-09")],
                    order_items=[item(1, 10, 1, 10)], sellers=[(1, "S1", "c1")])
    assert scorecard.seller_scorecard(t).first()["composite_score"] == 0.0


def test_three_state_filters_differ(make_tables):  # F5-F7
    t = make_tables(
        orders=[order(1, "2020-01-05", "2020-01-06", "2020-01-09")],
        order_items=[item(1, 10, 1, 10), item(1, 11, 2, 20)],
        sellers=[(1, "IN", "a"), (2, "OUT", "b")],
    )
    p = Params(seller_state="IN")
    assert set(rows(abc.product_revenue(t, p), "product_id")) == {10}  # item level
    m = monthly.monthly_revenue(t, p).first()
    assert m["revenue"] == 30.0 and m["active_sellers"] == 2  # whole order
    assert set(rows(scorecard.seller_scorecard(t, p), "seller_id")) == {1}  # seller rows


# --- params -------------------------------------------------------------------------------
def test_blank_params_mean_no_filter(make_tables):  # T4
    t = make_tables(orders=[order(1, "2020-01-05")], order_items=[item(1, 10, 1, 10)])
    assert monthly.monthly_revenue(t, Params("", "", "")).count() == 1


def test_end_date_is_midnight(make_tables):  # T5
    t = make_tables(
        orders=[order(1, "2020-01-31 00:00:00"), order(2, "2020-01-31 09:00:00")],
        order_items=[item(1, 10, 1, 10), item(2, 10, 1, 10)],
    )
    assert monthly.monthly_revenue(t, Params(end_date="2020-01-31")).first()["order_count"] == 1


def test_bad_date_rejected():
    with pytest.raises(ValueError):
        Params(start_date="2020-13-01")


# --- monthly ------------------------------------------------------------------------------
def test_lag_uses_previous_present_month_and_null_month_last(make_tables):  # W3, T6, T10
    t = make_tables(
        orders=[order(1, "2020-01-05"), order(2, "2020-03-05"), order(3, "2020-04-05"), order(4, None)],
        order_items=[item(1, 1, 1, 100), item(2, 1, 1, 150), item(3, 1, 1, 0), item(4, 1, 1, 10)],
    )
    g = {r["month"]: r for r in monthly.monthly_growth(t).collect()}
    assert g[ts("2020-01-01")]["mom_growth_pct"] is None
    assert g[ts("2020-03-01")]["mom_growth_pct"] == 50.0  # vs January, not the missing February
    assert g[ts("2020-04-01")]["mom_growth_pct"] == -100.0
    assert g[None]["mom_growth_pct"] is None  # NULL month sorts last: previous revenue is 0


# --- cohort ---------------------------------------------------------------------------------
def test_return_windows(make_tables):  # T13, T14
    first = "2020-01-01 12:00:00"
    t = make_tables(
        orders=[
            order(1, first), order(2, "2020-01-31 12:00:00"),  # person 100: exactly 30 days -> 30d
            order(3, first), order(4, "2020-01-31 12:00:01"),  # person 200: 30 days + 1 s -> 60d only
            order(5, first), order(6, first),  # person 300: same instant -> no return
            order(7, first),  # NULL person -> dropped
            order(8, "2020-01-02", status="canceled"),  # not active
        ],
        customers=[(1, 100, "A"), (2, 100, "A"), (3, 200, "A"), (4, 200, "A"), (5, 300, "A"), (6, 300, "A"),
                   (7, None, "A"), (8, 400, "A")],
    )
    c = cohort.cohort_retention(t).collect()
    assert len(c) == 1
    r = c[0]
    assert (r["cohort_size"], r["returned_30d"], r["returned_60d"], r["returned_90d"]) == (3, 1, 2, 2)
    assert r["retention_30d_pct"] == 33.33 and r["retention_60d_pct"] == 66.67


# --- delivery --------------------------------------------------------------------------------
def test_delivery_having_and_day_level_on_time(make_tables):  # F10, K13, T8
    orders_, customers = [], []
    for i in range(10):  # state A: 10 orders, delivered 23:00 -> estimated next day 01:00
        orders_.append(order(i, "2020-01-01 08:00:00", "2020-01-05 23:00:00", "2020-01-06 01:00:00"))
        customers.append((i, i, "A"))
    for i in range(10, 19):  # state B: 9 orders
        orders_.append(order(i, "2020-01-01", "2020-01-03", "2020-01-02"))
        customers.append((i, i, "B"))
    orders_.append(order(99, "2020-01-01 08:00:00", "2020-01-06 10:00:00", "2020-01-06 00:00:00"))
    customers.append((99, 99, "A"))  # later on the estimated day: on time by day
    t = make_tables(orders=orders_, customers=customers)
    d = rows(delivery.delivery_by_state(t), "state")
    assert set(d) == {"A"}
    a = d["A"]
    assert a["order_count"] == 11 and a["on_time_pct"] == 100.0
    assert a["min_actual_days"] == 4 and a["max_actual_days"] == 5


# --- checks ----------------------------------------------------------------------------------
def test_checks_warn_on_missing_tables_and_null_dates(make_tables):  # C1-C5, C4
    t = make_tables(absent=("sellers",), orders=[order(1, None)])
    rows_ = checks.all_checks(t, dt.datetime(2026, 1, 1)).collect()
    failed = {(r["check_name"], r["table_name"]) for r in rows_ if not r["passed"]}
    assert ("table_present", "sellers") in failed and ("table_present", "geolocation") in failed
    assert ("key_column_non_null", "sellers") in failed
    assert ("min_row_count", "orders") in failed
    assert ("date_range", "orders") in failed  # all purchase dates NULL: fails, no exception
    s = checks.check_summary(t, dt.datetime(2026, 1, 1)).first()
    assert s["passed"] is False and s["failed"] == len([r for r in rows_ if not r["passed"]])


def test_future_minimum_date_fails(make_tables):
    t = make_tables(orders=[order(1, "2030-01-01")])
    r = checks.check_date_range(t, dt.datetime(2026, 1, 1)).first()
    assert r["passed"] is False and r["observed"] == "2030-01-01 00:00:00"


def test_row_count_minimums_are_a_parameter(make_tables):
    t = make_tables(orders=[order(i, "2020-01-05") for i in range(5)])
    r = {x["table_name"]: x for x in checks.check_row_counts(t, {"orders": 5, "order_items": 0}).collect()}
    assert r["orders"]["passed"] and r["orders"]["threshold"] == "5" and r["order_items"]["passed"]
    assert set(r) == {"orders", "order_items"}


def test_operator_options(make_tables):  # K5 weights, K8 cuts, K11 windows, F10 threshold
    first = "2020-01-01 12:00:00"
    t = make_tables(
        orders=[order(1, first, "2020-01-02", "2020-01-03"), order(2, "2020-01-05 12:00:00", "2020-01-06", "2020-01-09"),
                order(3, "2020-01-02", "2020-01-04", "2020-01-03")],
        order_items=[item(1, 10, 1, 70), item(2, 11, 2, 20), item(3, 12, 2, 10)],
        customers=[(1, 100, "A"), (2, 100, "A"), (3, 300, "B")],
        sellers=[(1, "S", "a"), (2, "S", "b")],
    )
    c = cohort.cohort_retention(t, windows=(3, 7)).first()
    assert (c["returned_3d"], c["returned_7d"], c["retention_7d_pct"]) == (0, 1, 50.0)
    assert {r["window_days"] for r in cohort.cohort_retention_long(t, windows=(3, 7)).collect()} == {3, 7}
    tiers = rows(abc.abc_classification(t, fanout=False, cuts=(0.5, 0.9)), "product_id")
    # cumulative 0.70, 0.90 (exactly on the cut: inclusive), 1.00
    assert [tiers[p]["abc_class"] for p in (10, 11, 12)] == ["B", "B", "C"]
    sc = rows(scorecard.seller_scorecard(t, weights=(1.0, 0.0, 0.0)), "seller_id")
    assert sc[1]["composite_score"] == 100.0 and sc[2]["composite_score"] == 0.0  # revenue rank only: 70 > 30
    assert {r["state"] for r in delivery.delivery_by_state(t, min_orders=1).collect()} == {"A", "B"}
    assert delivery.delivery_by_state(t, min_orders=3).count() == 0
