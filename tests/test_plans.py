"""Plan properties: no Python in any plan, no unbounded single-task steps,
and the work inside whole-stage code generation."""

import re

import pytest

from conftest import SF_SMALL
from mercato.operators import abc, monthly, scorecard
from mercato.params import Params
from mercato.plans.jobs import recorded
from mercato.plans.registry import QUERIES, mapped_tables

# single-partition exchanges allowed: bounded by months, by three tiers, or global aggregates
BOUNDED_SINGLE = ("monthly_", "abc_tier_summary", "check_")


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_unbounded_single_partition(spark, name):
    with recorded() as jobs:
        df = QUERIES[name](spark, SF_SMALL)
    for kind, plan in jobs:  # stored frames; the small jobs collect global or per-bucket aggregates
        assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)
        assert kind == "collect" or "SinglePartition" not in plan or name.startswith(BOUNDED_SINGLE), name
    plan = _final_plan(df)
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)
    if not name.startswith(BOUNDED_SINGLE):
        assert "SinglePartition" not in plan, name


@pytest.mark.parametrize("name", ["seller_scorecard", "abc_classification", "cohort_retention",
                                  "delivery_by_state", "monthly_growth"])
def test_operators_run_in_whole_stage_codegen(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF_SMALL))
    op = re.compile(r"(\*\(\d+\) )?(HashAggregate|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|Project|Filter|Expand|Sort)\b")
    matches = [m for m in map(op.search, plan.splitlines()) if m]
    assert len(matches) >= 5  # the pattern does see the operators
    outside = [m.group(0) for m in matches if m.group(1) is None]
    assert not outside, outside


EXCHANGE = r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def _planned(df) -> str:
    """The plan before it runs (stored frames appear as scans of what was stored)."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_state_filter_of_monthly_costs_only_its_semi_join(spark, no_broadcast, monkeypatch):
    stored = []
    monkeypatch.setattr(monthly, "reliable", lambda df: stored.append(df) or df)
    t = mapped_tables(spark, SF_SMALL)
    plain = len(re.findall(EXCHANGE, _planned(monthly.monthly_growth(t))))
    semi = monthly.monthly_growth(t, Params(seller_state="NATION_3"))
    assert len(stored) == 1
    own = len(re.findall(EXCHANGE, _planned(stored[0])))
    # the stored orders carry the semi join; joining the items costs no more than without a state
    assert len(re.findall(EXCHANGE, _planned(semi))) <= plain + own
    assert "LeftSemi" in _planned(stored[0])


@pytest.mark.parametrize("params", [Params(), Params(seller_state="NATION_3")], ids=["all", "by state"])
def test_monthly_counts_without_expanding_rows(spark, no_broadcast, params):
    plan = _planned(monthly.monthly_growth(mapped_tables(spark, SF_SMALL), params))
    assert "Expand" not in plan and "Window" in plan
    # items, orders, (month, seller), month, and the growth window over the months
    assert len(re.findall(EXCHANGE, plan)) <= 5


def test_abc_filters_items_below_the_join(spark, no_broadcast):
    df = abc._product_revenue_exact(mapped_tables(spark, SF_SMALL), Params(seller_state="NATION_3"), fanout=True)
    lines = _planned(df).splitlines()
    depth = {k: min(i for i, line in enumerate(lines) if k in line) for k in ("Inner", "LeftSemi")}
    assert depth["Inner"] < depth["LeftSemi"]  # the semi join stands below the join with the orders


def test_ranking_job_of_the_scorecard_is_short(spark, no_broadcast):
    df = scorecard.seller_scorecard(mapped_tables(spark, SF_SMALL))
    plan = _planned(df)
    assert len(re.findall(EXCHANGE, plan)) <= 3  # one per ranked measure, of the rows themselves
    assert "SortMergeJoin" not in plan  # nothing is joined back


def test_ranking_job_of_abc_is_one_exchange(spark, no_broadcast):
    plan = _planned(abc.abc_classification(mapped_tables(spark, SF_SMALL)))
    assert len(re.findall(EXCHANGE, plan)) == 1 and "SortMergeJoin" not in plan
