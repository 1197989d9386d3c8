"""Random small inputs against brute-force Python versions of the reference semantics."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import money
from mercato.operators import abc, cohort

BASE = dt.datetime(2020, 1, 1)

purchase = st.tuples(
    st.one_of(st.none(), st.integers(0, 4)),  # person (NULL allowed)
    st.one_of(st.none(), st.sampled_from([0, 1, 86400 * 30, 86400 * 30 + 1, 86400 * 45, 86400 * 61, 86400 * 90,
                                          86400 * 95, 86400 * 40 + 7])),  # seconds after BASE
    st.sampled_from(["delivered", "shipped", "canceled", "unavailable", None]),
)


def _cohort_bruteforce(rows):
    by_person = defaultdict(list)
    for person, secs, status in rows:
        if status is None or status in ("canceled", "unavailable") or person is None or secs is None:
            continue
        by_person[person].append(BASE + dt.timedelta(seconds=secs))
    out = defaultdict(lambda: [0, 0, 0, 0])
    for ts in by_person.values():
        first = min(ts)
        later = [t for t in ts if t > first]
        second = min(later) if later else None
        month = dt.datetime(first.year, first.month, 1)
        out[month][0] += 1
        for j, days in enumerate((30, 60, 90)):
            if second is not None and second <= first + dt.timedelta(days=days):
                out[month][j + 1] += 1
    return {m: tuple(v) for m, v in out.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(purchase, min_size=1, max_size=25))
def test_cohort_matches_bruteforce(make_tables, rows):
    orders = [(i, i, status, None if secs is None else BASE + dt.timedelta(seconds=secs), None, None)
              for i, (_, secs, status) in enumerate(rows)]
    customers = [(i, person, "S") for i, (person, _, _) in enumerate(rows)]
    t = make_tables(orders=orders, customers=customers)
    got = {r["cohort_month"]: (r["cohort_size"], r["returned_30d"], r["returned_60d"], r["returned_90d"])
           for r in cohort.cohort_retention(t).collect()}
    assert got == _cohort_bruteforce(rows)


item = st.tuples(st.integers(0, 5), st.integers(0, 3), st.sampled_from([0, 1, 2, 5, 10]))  # order, product, price


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(items=st.lists(item, min_size=1, max_size=20), fanout=st.booleans())
def test_abc_matches_bruteforce_self_join(make_tables, items, fanout):
    orders = [(o, o, "delivered", BASE, None, None) for o in range(6)]
    t = make_tables(orders=orders, order_items=[(o, p, 1, money(v), money(0)) for o, p, v in items])
    # brute force: the literal self-join on order_id (each item once per item of its order)
    revenue, units = defaultdict(int), defaultdict(int)
    for o, p, v in items:
        partners = [x for x in items if x[0] == o] if fanout else [None]
        for _ in partners:
            revenue[p] += v
            units[p] += 1
    total = sum(revenue.values())
    expected = {}
    for p in revenue:
        cum = sum(r for r in revenue.values() if r >= revenue[p])  # RANGE frame, descending: ties included
        share = cum / total if total else None
        tier = "A" if share is not None and share <= 0.80 else "B" if share is not None and share <= 0.95 else "C"
        expected[p] = (float(revenue[p]), units[p], tier)
    got = {r["product_id"]: (r["revenue"], r["units_sold"], r["abc_class"])
           for r in abc.abc_classification(t, fanout=fanout).collect()}
    assert got == expected
